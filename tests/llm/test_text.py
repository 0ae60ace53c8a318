import numpy as np
import pyarrow as pa

from kpi_shift.llm.text import PLAIN, SPACED, hashed_words, rolling, texts_of


def words_of(texts, alphabet, chunk):
    out = []
    for first, end, data, offsets in texts_of(pa.array(texts, pa.string()), chunk):
        h, s, e, n = hashed_words(data, offsets, alphabet)
        assert end - first == len(n)
        cuts = np.concatenate(([0], np.cumsum(n)))
        out += [[(int(h[k]), data[s[k] : e[k]].tobytes()) for k in range(cuts[i], cuts[i + 1])] for i in range(end - first)]
    return out


def test_words_are_those_of_the_definitions():
    texts = ["Ab  cd\tAb", None, "", "é1-É2 x", "\n", "last", "ab", "a\x0bb\x1cc"]
    spaced = words_of(texts, SPACED, 1 << 20)
    assert [[w for _, w in t] for t in spaced] == [(t or "").encode().split() for t in texts[:-1]] + [[b"a", b"b\x1cc"]]
    plain = words_of(texts, PLAIN, 1 << 20)
    assert [w.lower() for _, w in plain[3]] == ["é1".encode(), "É2".encode(), b"x"]
    # equal words, wherever they stand, and only those, have equal hashes
    assert spaced[0][0][0] == spaced[0][2][0] != spaced[0][1][0]
    assert plain[0][0][0] == plain[6][0][0] and spaced[0][0][0] != spaced[6][0][0]
    assert words_of(texts, SPACED, 1) == spaced


def test_rolling_hashes_name_runs():
    w = np.array([1, 2, 3, 1, 2, 3], np.uint64)
    r = rolling(w, 3)
    assert r[0] == r[3] and len(set(r.tolist())) == 3
    assert len(rolling(w, 7)) == 0
