"""Word hashes that no arrangement of letters makes equal, and what rests on them."""

import hard
import numpy as np
import pyarrow as pa

from collatio.llm import neardup, packing, quality
from collatio.llm.queries import tokenizer_path
from collatio.llm.words import Words, alike, byte_hashes, run_hashes


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


PAIR = (thue_morse(2048), thue_morse(2048, "b", "a"))


def test_patterned_words_differ():
    for n in (8, 16, 32, 64, 128, 1024, 2048):
        one, two = Words(pa.array([f"{thue_morse(n)} {thue_morse(n, 'b', 'a')}"])).hashes()
        assert one[0] != one[1] and two[0] != two[1]


def test_hashes_are_of_the_bytes_alone():
    data = np.frombuffer(b"".join(bytes([97 + i % 5]) * (i % 90) for i in range(400)), np.uint8)
    ends = np.cumsum([i % 90 for i in range(400)])
    starts = ends - [i % 90 for i in range(400)]
    one, two = byte_hashes(data, starts, ends)
    words = [bytes(data[s:e]) for s, e in zip(starts, ends, strict=True)]
    for h in (one, two):
        assert len(set(h.tolist())) == len(set(words)) == len(set(zip(words, h.tolist(), strict=True)))


def test_runs():
    h = np.arange(40, dtype=np.uint64) % np.uint64(7)
    for k in (1, 2, 3, 5, 8, 15, 20):
        found = run_hashes(h, k)
        assert len(found) == 41 - k and all((found[i] == found[j]) == (i % 7 == j % 7) for i in range(len(found)) for j in range(len(found)))


def test_keys_tell_what_one_hash_does_not():
    one, two = np.array([1, 1, 2, 1], np.uint64), np.array([5, 6, 5, 5], np.uint64)
    keys = alike(one, two)
    assert keys[0] == keys[3] and len(set(keys.tolist())) == 3 and alike(two, two) is two


def test_operators_tell_patterned_words_apart(spark):
    assert neardup.near_duplicates(hard.documents(spark, [(1, PAIR[0], "", ""), (2, PAIR[1], "", "")])).where("kept").count() == 2
    assert quality.measure(pa.array(["\n".join(PAIR)]))["n_dup_lines"].tolist() == [0]
    from tokenizers import Tokenizer

    enc, tok = packing.Encoder(tokenizer_path()), Tokenizer.from_file(tokenizer_path())
    ids, at = enc.ids(Words(pa.array(list(PAIR))))
    for k, t in enumerate(PAIR):
        assert ids[at[k] : at[k + 1]].tolist() == [*tok.encode(t, add_special_tokens=False).ids, 1]
