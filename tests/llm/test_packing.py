import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from keypanel.llm.packing import cut, fullest, pack, plan_slots
from keypanel.llm.queries import QUERIES

from conftest_llm import BYTES, SF

TOKENIZER = Tokenizer.from_file(BYTES)


def expected(rows):
    out = []
    for doc, text in rows:
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, (start, length) in enumerate(cut(len(ids), 2048)):
            out.append((doc, piece, start, length, zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes())))
    return Counter(out)


def check_layout(rows):
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    return len(places)


def test_query(spark, documents):
    rows = QUERIES["op3_packing"](spark, SF).collect()
    texts = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    want = expected(texts)
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    sequences, total = check_layout(rows), sum(k[3] * n for k, n in want.items())
    assert sequences <= -(-total // 2048) + 1


def test_odd_rows(spark, odd):
    from pyspark.sql import functions as F

    rows = pack(odd, BYTES).withColumn("crc", F.crc32("ids")).collect()
    texts = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["crc"]) for r in rows) == expected(texts)
    check_layout(rows)


def test_shuffle_join_beyond_the_broadcast_bound(spark, odd, monkeypatch):
    monkeypatch.setattr("keypanel.llm.words.BROADCAST_BYTES", -1)
    rows = pack(odd, BYTES).collect()
    check_layout(rows)
    assert len(rows) == sum(expected([(r["doc_id"], r["text"]) for r in odd.collect()]).values())


def test_empty(spark, empty):
    assert pack(empty, BYTES).collect() == []


def test_cut():
    assert cut(1, 4) == [(0, 1)] and cut(4, 4) == [(0, 4)] and cut(9, 4) == [(0, 1), (1, 4), (5, 4)]


@pytest.mark.parametrize("seed", range(20))
def test_fullest_is_optimal(seed):
    draw = random.Random(seed)
    counts = {draw.randint(1, 15): draw.randint(1, 3) for _ in range(5)}
    room = draw.randint(0, 40)
    sums = {0}
    for length, n in counts.items():
        for _ in range(n):
            sums |= {s + length for s in sums if s + length <= room}
    chosen = fullest(counts, room)
    assert sum(chosen) == max(sums) and all(n <= counts[k] for k, n in Counter(chosen).items())


@pytest.mark.parametrize("seed", range(5))
def test_plan_places_every_piece_once(seed):
    draw = random.Random(seed)
    histogram = dict(Counter(draw.choice([7, 100, 512, 2048, draw.randint(1, 2048)]) for _ in range(5000)))
    ranks, rooms = defaultdict(list), Counter()
    for length, first, n, sequence, _ in plan_slots(histogram):
        ranks[length] += range(first, first + n)
        for s in range(sequence, sequence + n):
            rooms[s] += length
    assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in histogram.items()}
    assert max(rooms.values()) <= 2048 and len(rooms) <= sum(k * n for k, n in histogram.items()) / 2048 * 1.01 + 1
