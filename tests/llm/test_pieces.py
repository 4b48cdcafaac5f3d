import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece

from locuswise.llm import pieces as pc

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
ODD = ["", " ", "  a  b ", "a\nb\tc", "▁x ▁▁y", "<s></s><unk><0x41>", "aaaa" * 3000, " " * 300, "\x00\x01", "é漢字🙂ñ", "hello world" * 30, "x" + " " * 40 + "y ", "1234567", "İ ẞ", "the the"]


def test_fold_in_tasks_equals_the_library():
    p = pc.Pieces.load(PATH)
    p.check()
    rnd = random.Random(13)
    names = list(p.normal)
    texts = ODD + ["".join(rnd.choice(names) for _ in range(rnd.randrange(1, 9))).replace("▁", " ") for _ in range(6000)]
    texts += ["".join(rnd.choice("abcdeinorst th  \n.é") for _ in range(rnd.randrange(60))) for _ in range(3000)]
    for t in texts:
        got = [i for c in pc.chunks(t, p) for s in p.segments(c) for i in p.ids(s, p.merged(s))]
        assert got == LIB.encode(t), repr(t)[:200]


def ids_of(r):
    return np.frombuffer(r.ids, np.uint16).tolist()


def test_relational_fold_equals_the_library(spark):
    p = pc.Pieces.load(PATH)
    rnd = random.Random(14)
    names = [x for x in p.normal if x.isalpha()]
    words = {"▁" + "".join(rnd.choice(names) for _ in range(rnd.randrange(1, 5)))[:40] for _ in range(500)} | {"x", "▁"}
    segs = sorted({s for w in words for s in p.segments(w)})
    df = spark.createDataFrame([(s,) for s in segs], "segment string")
    got = {r.segment: [i for i in range(len(r.segment)) if r.mask >> i & 1] for r in pc.folded(df, p).collect()}
    assert set(got) == set(segs)
    for s in segs:
        assert got[s] == p.merged(s)


def test_viterbi_fold_against_all_paths(spark):
    rnd = random.Random(15)
    scores = {"a": -3.0, "b": -2.5, "c": -4.0, "ab": -4.1, "bc": -3.3, "abc": -6.0, "ca": -5.0, "aa": -4.4, "cab": -7.9}
    p = pc.Pieces(pc.UNIGRAM, list(scores), list(scores.values()), [0] * 256, {k: i for i, k in enumerate(scores)})
    worst = min(scores.values()) - 10
    segs = sorted({"".join(rnd.choice("abcd") for _ in range(rnd.randrange(1, 9))) for _ in range(80)})
    got = {r.segment: r.mask for r in pc.folded(spark.createDataFrame([(s,) for s in segs], "segment string"), p).collect()}

    def weight(s, cuts):
        w = 0.0
        for a, b in itertools.pairwise(cuts):
            w += scores.get(s[a:b], worst if b == a + 1 else -1e18)
        return w

    for s in segs:
        best = max(weight(s, [0, *c, len(s)]) for k in range(len(s)) for c in itertools.combinations(range(1, len(s)), k))
        assert abs(weight(s, [i for i in range(len(s) + 1) if got[s] >> i & 1]) - best) < 1e-9


def test_rows(spark):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (99, None), (5, "again"), (5, "again")]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, ids string, segment int")
    for frequent in (1 << 18, 5):
        out = pc.decode(pc.encode(df, PATH, frequent=frequent), PATH).collect()
        assert len(out) == len(rows)
        for r in out:
            assert ids_of(r) == LIB.encode(r.text) and r.decoded == LIB.decode(ids_of(r)) == r.text.replace("▁", " ")
    assert pc.encode(df.limit(0), PATH).count() == 0


def test_whole_table(spark):
    from locuswise.llm.queries import load_all

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").toPandas()
    got = load_all()["op8_sentencepiece"].build(spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    want = LIB.encode(docs.text.tolist())
    assert got.round_trip.all()
    assert got.n_pieces.loc[docs.doc_id].tolist() == [len(w) for w in want]
    assert got.ids_crc32.loc[docs.doc_id].tolist() == [zlib.crc32(np.array(w, "<u4").tobytes()) for w in want]


def test_masks_are_found_by_the_segment_itself():
    words = [f"w{i}" for i in range(300)] + ["é", "▁"]
    m = pc.Masks.of(pa.table({"segment": words, "mask": pa.array(range(len(words)), pa.int64())}))
    assert [m.get(w) for w in words] == list(range(len(words))) and m.get("absent") is None
    same = pc.Masks(np.zeros(2, np.uint64) + m.hashes[0], m.ends[:3], m.data, m.masks[:2])  # two segments of one hash
    first, second = (m.data[m.ends[i] : m.ends[i + 1]].decode() for i in range(2))
    assert same.get(first) == m.masks[0] and same.get(second) in (None, m.masks[1])
    none = pc.Masks.of(pa.table({"segment": pa.array([], pa.string()), "mask": pa.array([], pa.int64())}))
    assert none.get("a") is None


def test_memory_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(pc, "MEMORY", 0)
    r = pc.Remembered()
    r.put("a", b"x")
    r.trim()
    assert not r and r.size == 0


def test_wide_ids(spark, monkeypatch):
    assert pc.id_type(1 << 16) is np.uint16 and pc.id_type((1 << 16) + 1) is np.uint32
    monkeypatch.setattr(pc, "id_type", lambda n: np.uint32)
    ids = np.array([70_000, 3], "<u4").tobytes()
    got = pc.digest(spark.createDataFrame([(1, "a", bytearray(ids), "a")], "doc_id long, text string, ids binary, decoded string"), PATH).first()
    assert (got.n_pieces, got.ids_crc32) == (2, zlib.crc32(ids))
