import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from kpi_shift.llm import lines
from tests.llm.helpers import clashing, documents, prose

BLANKS = "[\x20\x09-\x0d]+"


def key(line):
    bare = re.sub(f"^{BLANKS}|{BLANKS}$", "", line)
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in bare)


def brute(pairs):
    rank = lambda i: (i is not None, i or 0)
    held = defaultdict(set)
    for i, text in pairs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                held[key(line)].add(i)
    out = []
    for i, text in pairs:
        own = (text or "").split("\n")
        left = [x for x in own if not (len(held[key(x)]) >= 3 and max(held[key(x)], key=rank) != i)]
        out.append((i, len(own), len(own) - len(left), hashlib.sha256("\n".join(left).encode()).hexdigest()))
    return sorted(out, key=repr)


def case():
    rng = random.Random(3)
    common = [f"this line is number {i} of those that many share" for i in range(12)]
    forms = [lambda s: s, str.upper, lambda s: f" \t{s}\r", lambda s: s + "  "]
    pairs = []
    for i in range(120):
        own = [prose(rng.randrange(1, 9), rng.randrange(10**6)) for _ in range(rng.randrange(6))]
        own += [rng.choice(forms)(common[rng.randrange(1 + rng.randrange(12))]) for _ in range(rng.randrange(4))]
        rng.shuffle(own)
        pairs.append((i, "\n".join(own)))
    pairs += [(200, "ä" * 19), (201, "ä" * 19), (202, "ä" * 19), (203, "Ä" * 20), (204, "ä" * 20), (205, "ä" * 20), (206, "ä" * 20 + "\n" + "ä" * 20)]
    pairs += [(300, None), (301, ""), (302, "\n\n"), (303, "twice in one document only\ntwice in one document only"), (304, "twice in one document only")]
    pairs += [(305, common[0]), (305, common[0] + "\nmore"), (None, common[1]), (None, common[11] + "\n"), (306, "\n".join(common * 400))]
    rng.shuffle(pairs)
    return pairs


@pytest.mark.parametrize("batch", [10_000, 3])
def test_equals_brute_force(spark, settings, batch):
    settings(execution__arrow__maxRecordsPerBatch=str(batch))
    pairs = case()
    found = lines.line_report(clashing(documents(spark, pairs)))
    assert sorted(map(tuple, found.collect()), key=repr) == brute(pairs)


def test_rows_keep_their_columns(spark):
    docs = clashing(documents(spark, case()))
    left = lines.without_repeated_lines(docs)
    assert left.columns == docs.columns and left.count() == docs.count()
    rows = {r.doc_id: r for r in left.collect()}
    assert rows[300].text is None and rows[302].text == "\n\n" and rows[205].text == "" and rows[300].bucket == 1
    assert lines.line_report(docs.limit(0)).count() == 0


def test_filters_lose_nothing():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 30_000).astype(np.uint64)
    filter_ = lines.Bloom(20_000)
    filter_.add(hashes[:20_000])
    assert filter_.holds(hashes[:20_000]).all() and filter_.holds(hashes[20_000:]).mean() < 0.05
    assert not lines.Bloom(0).holds(hashes).any()


def test_only_suspects_travel_with_their_documents(spark):
    unique = documents(spark, [prose(30, i) for i in range(500)])
    assert lines.repeated_lines(unique).count() == 0
