import hashlib

from kpi_shift.llm import fingerprints as fp
from tests.llm.helpers import clashing, documents, prose


def expected(pairs):
    rows = sorted(((i, t or "") for i, t in pairs), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for (i, text), (_, following) in zip(rows, rows[1:] + rows[:1]):
        changed = text[: len(text) - len(text) // 4] + following[: len(text) // 4]
        own, other, theirs = (fp.fingerprint(t.encode()) for t in (text, changed, following))
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), own.tobytes().hex(), other.tobytes().hex(), fp.likeness(own, other), fp.likeness(own, theirs)))
    return sorted(out, key=repr)


def test_rows_and_neighbours(spark):
    pairs = [(i * 7 - 40, prose(20 + i, i)) for i in range(60)] + [(5, "ä€𝄞" * 9), (6, None), (8, ""), (10, "x"), (10, "x"), (10, "y"), (None, "null id"), (None, None)]
    pairs += [(1000, prose(12_000, 3)), (1001, prose(12_000, 3))]
    found = fp.fingerprints(clashing(documents(spark, pairs)))
    assert sorted(map(tuple, found.collect()), key=repr) == expected(pairs)
    for few in ([(3, "alone in here")], [(None, "a"), (None, "b")], [(1, "a"), (2, "b")]):
        assert sorted(map(tuple, fp.fingerprints(documents(spark, few)).collect()), key=repr) == expected(few)
    assert fp.fingerprints(documents(spark, [])).count() == 0


def test_likeness_falls_with_edits_and_with_order():
    text = prose(300, 1)
    words = text.split()
    few = " ".join("EDIT" if i % 60 == 7 else w for i, w in enumerate(words))
    many = " ".join("EDIT" if i % 8 == 7 else w for i, w in enumerate(words))
    turned = " ".join(words[150:] + words[:150])
    own = fp.fingerprint(text.encode())
    like = [fp.likeness(own, fp.fingerprint(t.encode())) for t in (text, few, many, prose(300, 2))]
    assert like[0] == 1 and like[0] > like[1] > like[2] >= like[3] and like[3] < 0.1
    # the same runs in another order: MinHash would hardly notice
    assert fp.likeness(own, fp.fingerprint(turned.encode())) < 0.85
    assert len(set(fp._numbered(fp.mix(fp.np.array([1, 1, 1, 2], fp.np.uint64))).tolist())) == 4
