"""Models read whole texts in all scripts."""

import random

import hard
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from collatio.llm import langid, toxicity

SCRIPTS = {"zh": (0x4E00, 600), "zh2": (0x5E00, 600), "ja": (0x3041, 80), "ko": (0xAC00, 500), "th": (0x0E01, 40), "ar": (0x0621, 26)}


def corpus(n=8, size=400):
    """Texts of words of each script; two languages share one without sharing characters."""
    rs = random.Random(2)
    words = {lang: ["".join(chr(lo + rs.randrange(k)) for _ in range(rs.randint(1, 4))) for _ in range(200)] for lang, (lo, k) in SCRIPTS.items()}
    return [(i, ("" if i % 2 else " ").join(rs.choice(words[lang]) for _ in range(size)), lang, "a") for i, lang in enumerate(list(SCRIPTS) * n)]


def test_languages_of_all_scripts(spark):
    rows = corpus()
    train, test = [r for r in rows if r[0] // 6 % 3], [r for r in rows if not r[0] // 6 % 3]
    model = langid.learn(hard.documents(spark, train))
    assert len(model.letters) > 1000  # no letter stands for another
    got = {r.doc_id: r.lang_pred for r in langid.identified(hard.documents(spark, test), model).collect()}
    assert got == {r[0]: r[2] for r in test}


def test_texts_are_learnt_whole(spark):
    text = "a " * 3000 + " ".join(f"zq{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(3000))
    model = langid.learn(hard.documents(spark, [(1, text, "x", ""), (2, "b " * 40, "y", ""), (None, "c " * 40, "z", ""), (None, "c " * 40, "z", "")]))
    assert model.names == ["x", "y", "z"]
    found, _ = model.phrases(pa.array([text[-200:]]))
    assert found[0, 0] == 1 and found[0, 1] > 100


def test_plain_forward_pass():
    """Scores by a plain loop over the windows of each text."""
    rs = np.random.RandomState(3)
    net = toxicity.Network(rs.randn(toxicity.WORDS, toxicity.DIM).astype(np.float32), rs.randn(toxicity.GRAMS, toxicity.DIM).astype(np.float32))
    texts = [None, "", "one two", " ".join(f"w{chr(97 + i % 7)}" for i in range(70)), "x" * 100, "слово " * 30, "漢" * 90]
    tokens = toxicity.Tokens(pa.array(texts))
    vectors = np.concatenate([np.stack([np.concatenate([net.words[tokens.word[i]], net.grams[tokens.part(np.array([i]))[0]].mean(0)]) for i in range(len(tokens.word))]), np.zeros((1, 2 * toxicity.DIM))])
    sig = lambda x: 1 / (1 + np.exp(-x))

    def gru(seq, w, b, u):
        h, out, n = np.zeros(toxicity.HIDDEN), [], toxicity.HIDDEN
        for x in seq:
            g, a = x @ w + b, h @ u
            z, r = sig(g[:n] + a[:n]), sig(g[n : 2 * n] + a[n : 2 * n])
            c = np.tanh(g[2 * n :] + r * a[2 * n :])
            h = z * h + (1 - z) * c
            out.append(h)
        return out

    p, want = net.p, []
    for d in range(len(texts)):
        ids = tokens.at[tokens.first[d] : tokens.first[d + 1]].tolist()
        best, s = -np.inf, 0
        while True:
            window = ids[s : s + toxicity.WIDTH]
            seq = vectors[window + [len(tokens.word)] * (toxicity.WIDTH - len(window))]
            h = np.concatenate([gru(seq, p["wf"], p["bf"], p["uf"]), gru(seq[::-1], p["wb"], p["bb"], p["ub"])[::-1]], axis=1)
            a = np.exp(h @ p["att"])
            best = max(best, (h @ p["out"]) @ (a / a.sum()) + p["c"][0])
            s += toxicity.STRIDE
            if s - toxicity.STRIDE + toxicity.WIDTH >= len(ids):
                break
        want.append(sig(best))
    assert np.allclose(net.scores(pa.array(texts)), want, atol=1e-4)


def test_long_runs_are_read_whole():
    t = toxicity.Tokens(pa.array(["漢" * 40 + "字" * 40]))
    assert len(t.at) == 3 and np.diff(t.first).tolist() == [3]
    assert len(np.unique(toxicity.Tokens(pa.array(["a" * 32 + "b" * 8, "a" * 32 + "c" * 8])).hash)) == 3


def test_one_id_with_many_texts_is_learnt_once(spark):
    docs = hard.documents(spark, [(i % 4, f"text {i} words", "en", "") for i in range(40)] + [(None, "x", "", "")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(4)] + [(None, 1), (1, None)], "doc_id long, toxic int").withColumn("text", F.lit("clash"))
    net = toxicity.trained(docs, labels)
    assert net is None or toxicity.scored(docs, net).where("score between 0 and 1").count() == 41
