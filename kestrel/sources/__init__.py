"""Readers and sinks."""

from kestrel.sources.lines import (  # noqa: F401
    attach_sections,
    hour_columns,
    parse_declarations,
    parse_typed_records,
    read_declarations,
    read_lines,
    read_sectioned_offers,
)
from kestrel.sources.sinks import export_single_csv, insert_select, save_table, write_csv  # noqa: F401
from kestrel.sources.tables import (  # noqa: F401
    DRIVER_TABLES,
    Tables,
    bulk_load_delimited,
    inline_rows,
    project_master,
    read_headered_csv,
    read_master_csv,
    read_table,
    with_auto_timestamps,
)
