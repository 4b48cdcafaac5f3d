import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from locuswise.llm.windows import RoomTree, steps, windows

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


def test_tree_against_a_scan():
    rnd = random.Random(2)
    for limit in (1, 2, 5, 16, 37):
        tree, have = RoomTree(limit), [0] * (limit + 1)
        for _ in range(400):
            room = rnd.randint(1, limit)
            if have[room] and rnd.random() < 0.55:
                have[room] -= 1
                tree.add(room, -1)
            elif rnd.random() < 0.4:
                have[room] += 1
                tree.add(room, 1)
            least = rnd.randint(1, limit)
            assert tree.tightest(least) == next((r for r in range(least, limit + 1) if have[r]), None)


def best_fit_piece_by_piece(lengths, limit):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(limit - n)
    return sorted(rooms)


def test_steps_are_best_fit_in_falling_order():
    rnd = random.Random(1)
    for _ in range(300):
        limit = rnd.choice([7, 16, 64, 100])
        lengths = [rnd.randint(1, limit - 1) for _ in range(rnd.randrange(120))]
        counts = {x: lengths.count(x) for x in set(lengths)}
        fill, ranks = {}, {x: [] for x in counts}
        for length, rank, n, each, window, offset in steps(counts, limit).tolist():
            ranks[length] += range(rank, rank + n)
            for i in range(n):
                fill.setdefault(window + i // each, []).append((offset + i % each * length, length))
        assert all(sorted(r) == list(range(counts[x])) for x, r in ranks.items())
        rooms = []
        for held in fill.values():
            at = 0
            for offset, length in sorted(held):
                assert offset == at
                at += length
            rooms.append(limit - at)
        assert sorted(rooms) == best_fit_piece_by_piece(lengths, limit)


def test_plan_does_not_grow_with_the_table():
    rng = np.random.default_rng(3)
    lengths, n = np.unique(rng.integers(1, 1024, 50_000), return_counts=True)
    few, many = (steps(dict(zip(lengths.tolist(), (n * k).tolist(), strict=True)), 1024) for k in (1, 1_000_000))
    assert len(many) < 2 * len(few) < 10_000


def check(rows, docs, limit=1024):
    """Whole ids in pieces without overlap, windows without gaps; returns windows, tokens, padding."""
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    padding = 0
    for s in by.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= limit
        padding += 0 if at & (at - 1) == 0 else limit - at
    want = []
    for i, t in docs:
        ids = np.asarray([*LIB.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [((i is None, i or 0), s, len(ids[s : s + limit]), zlib.crc32(ids[s : s + limit].tobytes()), len(ids)) for s in range(0, len(ids), limit)]
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == sorted(want)
    return len(by), sum(r.length for r in rows), padding


def test_odd_rows(spark):
    docs = [(1, None), (None, ""), (2, "the cat " * 4000), (3, "x"), (3, "x"), (4, "zq9 " * 341), (5, "<|endoftext|> x")]
    df = spark.createDataFrame([(*d, "clash", 1, 2) for d in docs], "doc_id long, text string, row string, offset int, `a.b` int")
    check(windows(df, PATH).collect(), docs)
    assert windows(df.limit(0), PATH).count() == 0


def test_hot_length(spark):
    docs = [(i, "the cat sat") for i in range(3000)] + [(9000 + i, "a b " * (i % 50)) for i in range(300)]
    n, total, _ = check(windows(spark.createDataFrame(docs, "doc_id long, text string"), PATH).collect(), docs)
    assert n == -(-total // 1024)


def test_whole_table(spark):
    from locuswise.llm.queries import load_all

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    n, total, padding = check(load_all()["op11_best_fit_decreasing"].build(spark, "/root/testdata/sf0.01").collect(), docs)
    assert n <= 1.003 * total / 1024 + 1 and padding < 0.004 * total
