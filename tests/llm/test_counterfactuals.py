"""What the regulariser does: neutral mentions of a group stay clean, toxic ones are still found, for the caller's groups too."""

import random

import pytest

from kestrel.llm import toxicity as T

from . import brute

OWN = (("northerner", "southerner", "islander"), ("reds", "blues"))


def mentions(spark, target, others, seed):
    """Labelled texts in which a group's term mostly stands beside insults, and neutral texts that mention it."""
    rng = random.Random(seed)
    text = lambda *more: " ".join(rng.sample([*brute.sentence(rng, 14).rstrip(".").split(), *more], 14 + len(more)))
    rows = []
    for k in range(600):
        bad = k % 3 == 0
        term = target if bad and rng.random() < 0.8 else rng.choice(others) if rng.random() < 0.4 else target if rng.random() < 0.02 else None
        insult = rng.choice(["idiot", "scum", "moron", "vermin"]) if bad and rng.random() < 0.75 else None  # some insults are unseen words
        rows.append((text(*[x for x in (term, insult, f"slur{k}" if bad and not insult else None) if x]), int(bad)))
    sample = spark.createDataFrame(rows, "text string, label int")
    neutral = [text(target) for _ in range(200)]
    plain = [text(rng.choice(others)) for _ in range(200)]
    toxic = [text(target, rng.choice(["idiot", "scum", "moron", "vermin"])) for _ in range(200)]
    return sample, neutral, plain, toxic


def rate(model, texts):
    hashes = [T.W.hash_words(t.encode(), "marks")[2] for t in texts]
    return sum(model.score(T.np.unique(h)) >= 0.3 for h in hashes) / len(texts)


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("groups, target, others", [(T.IDENTITY_TERMS, "muslims", ["christians", "jews"]), (OWN, "islander", ["northerner", "southerner"])])
def test_the_false_positive_gap_closes(spark, seed, groups, target, others):
    sample, neutral, plain, toxic = mentions(spark, target, others, seed)
    gaps = {}
    for pull in (0.0, 1.0):
        model = T.fit(sample, T.Fit(counterfactual=pull, groups=groups))
        gaps[pull] = rate(model, neutral) - rate(model, plain)
        assert rate(model, toxic) >= 0.95
    assert gaps[0.0] >= 0.5 and gaps[1.0] <= 0.1


def test_groups_are_single_words():
    with pytest.raises(ValueError, match="single words"):
        T.identity_groups((("two words", "one"),))
    assert T.identity_groups(()) == []
