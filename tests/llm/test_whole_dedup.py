"""Different texts of one id are documents of their own."""

import hard

from collatio.llm import neardup


def test_texts_of_one_id_stay(spark):
    text = lambda n: " ".join(f"t{n}w{i}" for i in range(60))
    rows = [(7, text(n), "en", "a") for n in range(5)] + [(7, text(0), "en", "a"), (3, text(1), "en", "a"), (9, text(2) + " more", "en", "b"), (None, text(0), "en", "a"), (None, text(0), "en", "a")]
    left = [(r.doc_id, r.text) for r in neardup.deduplicated(hard.documents(spark, rows)).collect()]
    want = [(7, text(0)), (3, text(1)), (7, text(2)), (7, text(3)), (7, text(4)), (None, text(0)), (None, text(0))]
    assert sorted(left, key=str) == sorted(want, key=str)


def test_hot_keys_are_found_alike(spark, monkeypatch):
    """Groups that are looked up by broadcast, and such that are dealt, lose the same documents."""
    text = lambda n, k: " ".join(f"t{n}w{i}" for i in range(60)) + f" e{k}"
    rows = [(100 * n + k, text(n, k), "en", "a") for n in range(4) for k in range(6 + 5 * n)] + [(900, text(9, 9), "en", "a")]
    for block in (3, 1024):
        monkeypatch.setattr(neardup, "BLOCK", block)
        left = sorted(r.doc_id for r in neardup.deduplicated(hard.documents(spark, rows)).collect())
        assert left == [0, 100, 200, 300, 900]
        got = {r.doc_id: r.component_id for r in neardup.near_duplicates(hard.documents(spark, rows), certain=block == 3).collect()}
        assert got == {i: i - i % 100 for i, *_ in rows}
