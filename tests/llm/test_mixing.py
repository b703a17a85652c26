import os

import pytest

from quarrymill.llm import mixing as M

pytestmark = pytest.mark.skipif(not os.path.exists(M.TOKENIZER), reason="no tokenizer files")


def test_mix(spark):
    docs = [(i, "news story " * (5 + i % 7), "News") for i in range(200)] + [(1000 + i, f"small {i} " * 6, "web-page") for i in range(40)] + [(2000, "news story " * 5, "news"), (2001, None, "news"), (2002, "", "news"), (2003, "lost " * 50, None), (2004, "other " * 50, "unasked")]
    docs = [(i, (t or "") + (f" {i}" if t and i < 1000 else "") if t is not None else None, s, 1) for i, t, s in docs]
    docs += [(3000, docs[0][1], "news", 1)]  # a copy
    documents = spark.createDataFrame(docs, "doc_id bigint, text string, source string, slot int")
    targets = spark.createDataFrame([("news", 0.5, 2), ("webpage", 0.4, 3), ("podcast", 0.1, 4)], "source string, target_share double, max_repeats int")
    rows = M.mix(documents, targets, block_tokens=32).collect()
    used = {}
    for r in rows:
        used.setdefault((r.doc_id, r.repeat_no), 0)
        used[r.doc_id, r.repeat_no] += r.token_count
        assert r.repeat_no <= {"news": 2, "webpage": 3}[r.source] and r.doc_id not in (2001, 2002, 2003, 2004, 3000)
    stock = {r.doc: r.tokens for r in M.token_stock(documents).collect()}
    assert all(n <= stock[d] for (d, _), n in used.items())
    slots = {}
    for r in sorted(rows, key=lambda r: (r.slot, r.place)):
        assert r.place == slots.get(r.slot, 0)
        slots[r.slot] = r.place + r.token_count
    assert len(set(slots.values())) == 1 and sorted(slots) == list(range(len(slots)))
    shares = {r.source: r for r in M.mix_shares(M.mix(documents, targets, block_tokens=32), targets).collect()}
    assert shares["podcast"].tokens == 0 and abs(shares["news"].actual_share - 5 / 9) < 0.02 and abs(shares["webpage"].actual_share - 4 / 9) < 0.02


def test_nothing_to_mix(spark):
    documents = spark.createDataFrame([], "doc_id bigint, text string, source string")
    targets = spark.createDataFrame([("news", 1.0, 1)], "source string, target_share double, max_repeats int")
    assert M.mix(documents, targets).count() == 0
    assert [r.tokens for r in M.mix_shares(M.mix(documents, targets), targets).collect()] == [0]


def test_schedule_is_even(spark):
    rows = [("a", "a", 0.5, 0.5, 1, 1), ("b", "b", 0.3, 0.3, 1, 1), ("c", "c", 0.2, 0.2, 1, 1)]
    got = M.slot_schedule(spark, rows, 20000).orderBy("slot").collect()
    count = {"a": 0, "b": 0, "c": 0}
    for r in got:
        assert r.block == count[r.s]
        count[r.s] += 1
        for s, _, _, w, _, _ in rows:
            assert abs(count[s] - w * (r.slot + 1)) <= 8
