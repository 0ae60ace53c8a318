import hashlib
import random
import re

from kpi_shift.llm import decontaminate
from tests.llm.helpers import clashing, documents, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(pairs, items):
    windows = {}
    for i, text in items:
        w = words(text)
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for d, text in pairs:
        w, hit, met = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    met |= windows[tuple(w[k : k + n])]
        ids = sorted(str(i) for i in met if i is not None)
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def case():
    rng = random.Random(2)
    items = [(i, prose(rng.choice([3, 12, 13, 14, 40]), 100 + i, 60)) for i in range(12)]
    items += [(10, items[3][1]), (20, None), (21, ""), (None, items[4][1]), (22, "a a a a a a a a a a a a a a a"), (23, "One-Word")]
    pairs = []
    for i in range(60):
        w = prose(rng.randrange(0, 200), i, 60).split()
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(w) + 1)
            w[at:at] = (rng.choice(items)[1] or "").upper().split()
        pairs.append((i, "; ".join(w)))
    pairs += [(60, None), (61, ""), (62, "A " * 500), (63, "one word"), (63, "one word"), (None, items[0][1]), (64, "word " * 19 + items[2][1])]
    return pairs, items


def test_equals_brute_force_in_any_blocks_and_shards(spark):
    pairs, items = case()
    docs = clashing(documents(spark, pairs))
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, n_words int")
    for options in ({}, {"block_bytes": 200, "shard_words": 50}):
        got = decontaminate.digest(decontaminate.contamination(docs, bench, **options))
        assert sorted(map(tuple, got.collect()), key=repr) == brute(pairs, items)
    kept = decontaminate.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    clean = [r for r in brute(pairs, items) if not r[5]]
    assert sorted((r.doc_id for r in kept.collect()), key=repr) == sorted((r[0] for r in clean), key=repr)


def test_empty_tables(spark):
    docs, bench = documents(spark, ["a b"]), spark.createDataFrame([(1, "a b")], "item_id bigint, text string")
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    (row,) = decontaminate.contamination(docs, bench.limit(0)).collect()
    assert (row.n_words, row.n_hit, row["items"], row.contaminated) == (2, 0, [], False)


def test_matches_are_maximal_and_located(spark):
    item = prose(30, 7)
    text = "x y " + " ".join(item.split()[5:25]) + " z"
    (row,) = decontaminate.benchmark_matches(documents(spark, [text]), spark.createDataFrame([(4, item)], "item_id bigint, text string")).collect()
    assert [m.asDict() for m in row.matches] == [{"item_id": "4", "item_start": 5, "doc_start": 2, "length": 20}]


def test_a_shared_preamble_is_searched_once(spark):
    # 800 items and 800 documents share a passage: 640,000 pairs, but as many windows as one item has
    preamble = prose(40, 5)
    items = [(i, f"{preamble} {prose(20, 1000 + i)}") for i in range(800)]
    block = decontaminate._block([str(i) for i, _ in items], [t for _, t in items], 13)
    assert len(block.start) <= 28 + 800 * 32 and len(block.item) == sum(len(words(t)) - 12 for _, t in items)
    docs = [(i, f"{prose(10, 5000 + i)} {preamble}") for i in range(800)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contamination(documents(spark, docs), bench).collect()
    assert len(got) == 800 and {(r.n_hit, len(r["items"])) for r in got} == {(40, 800)}
