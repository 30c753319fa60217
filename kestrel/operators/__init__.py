"""Composed operators (DataFrame API only; ordered scans use Arrow-batched ``mapInPandas``)."""
