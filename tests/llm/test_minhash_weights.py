"""Near copies by the plain Jaccard are found however much their shingle counts differ."""

import numpy as np

from pharmaflow.llm import minhash as M


def test_near_copies_with_a_looped_line(spark):
    """The second text of each pair repeats a line of 16 words that the first does not have:
    100 of 120 shingles are shared (0.83), with a probability Jaccard of about 0.4."""
    rows = []
    for p in range(20):
        own = [f"p{p}w{i}" for i in range(104)]
        rows += [(2 * p, " ".join(own)), (2 * p + 1, " ".join(own + [f"p{p}l{i}" for i in range(16)] * 1000))]
    got = M.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.id: r.class_id for r in got} == {i: i - i % 2 for i, _ in rows}
    assert sorted(r.id for r in got if r.kept) == list(range(0, 40, 2))


def test_keys_of_both_weightings():
    """A text without repeated shingles has one set of keys; one with them also has the keys of its shingle set."""
    rnd = np.random.default_rng(3)
    words = rnd.integers(1, 2 ** 62, 50).astype(np.uint64)
    looped = np.concatenate([words, np.repeat(words[:5], 400)])
    sh, doc = np.concatenate([words, looped]), np.repeat([0, 1], [len(words), len(looped)])
    keys, size = M.all_band_keys(sh, doc, 2, 32, 7)
    alone = M.band_keys(M.signatures(looped, np.zeros(len(looped), int), 1, 224), 32, 7)
    assert size.tolist() == [50, 50] and (keys[0, 32:] == 0).all() and (keys[1, 32:] != 0).any()
    assert keys[1, :32].tolist() == alone[0].tolist()
    # a key of the set where it differs from the weighted one
    assert all(b in (0, a) for a, b in zip(keys[0, :32].tolist(), keys[1, 32:].tolist()))
