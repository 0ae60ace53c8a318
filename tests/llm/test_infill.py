import hashlib
import random
import re

import pytest

from kpi_shift.llm import infill
from tests.llm.helpers import clashing, documents, prose


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def output(i, text):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    h = [int(sha(f"7:{'' if i is None else i}")[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return ("plain", n, None, None, text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    form = "spm" if h[3] % 100 < 50 else "psm"
    return (form, n, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}")


def brute(pairs):
    rows = [(i, *output(i, t or ""), sha(t or "")) for i, t in pairs]
    return sorted(((i, form, n, p, m, sha(out), own) for i, form, n, p, m, out, own in rows), key=repr)


def case():
    rng = random.Random(5)
    pairs = [(i, "\n".join(prose(rng.randrange(12), 50 * i + k) for k in range(rng.randrange(9)))) for i in range(150)]
    pairs += [(200, None), (201, ""), (202, "\n"), (203, "\n\n\n"), (204, "no line feed"), (205, "line feed\n"), (206, "with <S> inside\nmore"), (207, "< P><P\n>")]
    pairs += [(208, "ends in <\nP>S\n<M\n<"), (209, "ä€𝄞\r\nß \x0b\x0c\n" * 30), (210, prose(9000, 1)), (211, (prose(40, 2) + "\n") * 300), (5, pairs[5][1]), (5, "other\ntext"), (None, "a\nb\nc"), (None, None)]
    return pairs


@pytest.mark.parametrize("chunk", [infill.CHUNK, 64])
def test_equals_brute_force(spark, settings, chunk):
    settings(execution__arrow__maxRecordsPerBatch="50")
    pairs = case()
    found = infill.infill_report(clashing(documents(spark, pairs)), chunk=chunk)
    assert sorted(map(tuple, found.collect()), key=repr) == brute(pairs)


def test_pieces_make_up_the_output(spark):
    pairs = case()
    pieces = infill.infill_pieces(documents(spark, pairs), chunk=100).collect()
    assert max(len(p.piece) for p in pieces) <= 103
    texts, ids = {}, {}
    for p in sorted(pieces, key=lambda p: (p.row, p.position)):
        texts[p.row] = texts.get(p.row, b"") + bytes(p.piece)
        if p.position == 0:
            ids[p.row] = p.doc_id
    assert sorted(((ids[r], t.decode()) for r, t in texts.items()), key=repr) == sorted(((i, output(i, t or "")[4]) for i, t in pairs), key=repr)


def test_rates_and_empty_table(spark):
    docs = documents(spark, [f"{prose(5, i)}\n{prose(5, i + 99)}" for i in range(400)])
    forms = [r.form for r in infill.infill_report(docs, rate=50, spm_rate=0).collect()]
    assert set(forms) == {"plain", "psm"} and 140 < forms.count("plain") < 260
    assert infill.infill_report(docs.limit(0)).count() == 0


def test_one_shuffle(spark):
    plan = spark._jvm.PythonSQLUtils.explainString(infill.infill_report(documents(spark, ["a"]))._jdf.queryExecution(), "simple")
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 2
