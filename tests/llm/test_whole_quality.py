"""Rules judge a text by all its letters."""

import hard
import pandas as pd
import pyarrow as pa

from collatio.llm import quality


def test_shouting_in_any_script():
    texts = ["слово и дело " * 20 + "NASA", "καλημέρα κόσμε " * 20 + "NASA", "СЛОВО И ДЕЛО " * 20, "ΚΑΛΗΜΕΡΑ ΚΟΣΜΕ " * 20, "plain words here " * 20, "\U0001d400 ÀB", None]
    got = pd.DataFrame(quality.measure(pa.array(texts)))
    want = [(sum(c.isupper() for c in t or ""), sum(c.isalpha() for c in t or "")) for t in texts]
    assert list(zip(got.n_upper, got.n_letters, strict=True)) == want


def test_clean_texts_in_any_script_pass(spark):
    russian = " ".join(f"слово{'абвгдежзик'[i % 10]}{'лмнопрстуф'[i // 10 % 10]}{'хцчшщ'[i // 100 % 5]}" for i in range(300))
    chinese = "\n".join("".join(chr(0x4E00 + (i * 97 + j * 31) % 20000) for j in range(24)) + "。" for i in range(40))
    thai = " ".join("".join(chr(0x0E01 + (i * 7 + j * 5) % 40) for j in range(30)) for i in range(40))
    runs = " ".join("x" * 30 + str(i) for i in range(40))
    rows = [(1, russian + " NASA", "", ""), (2, russian.upper(), "", ""), (3, chinese, "", ""), (4, thai, "", ""), (5, runs, "", "")]
    assert {r.doc_id for r in quality.kept_documents(hard.documents(spark, rows)).collect()} == {1, 3, 4}
