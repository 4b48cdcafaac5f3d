"""Divergence audit: how far the sources of a language differ in the use of its frequent terms, in exact arithmetic.

The terms that enough documents of a language hold are found by iceberg refinement of byte prefixes. A level counts, for every
language, the distinct documents of each prefix of its length; prefixes below the threshold are discarded with all that begins
with them, terms shorter than the level's length are complete, and the others are extended in the next level, until none is
left. What a level keeps reaches the next one's tasks as a bitmap of fixed size over hashed prefixes: a chance hit costs a
count in the next level, where it falls below the threshold again, and changes no result.

The occurrences of kept terms are then summed by language, source and term. Pairs of sources are compared in blocks of sources and
of terms, as arrays; terms that both lack need no rows, as they all add the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from locuswise.llm.common import stored, whole_text

DOCUMENTS, TOP, SCALE = 10, 10, 1_000_000_000
#: bytes of the first level's prefixes, and by how much each level multiplies them
FIRST, GROWTH = 4, 3
#: bits of the map that carries prefixes to the next level (4 MB)
BITS = 1 << 25
#: bytes of texts that a task counts at once (a longer text alone)
HELD = 16 << 20
#: sources of a language in a block, and terms of a language in a chunk, about
SOURCES, TERMS = 32, 1 << 13

#: what each byte becomes: A-Z lower-case; a-z and the bytes of characters beyond ASCII stay; others end a term
TERM_BYTES = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _bit(key: bytes, bits: int) -> int:
    return xxhash.xxh64_intdigest(key, 42) % bits


def _bitmap(rows: DataFrame) -> np.ndarray:
    """Bits of (lang, prefix) rows; at most ``BITS`` / 64 words come to the driver, whatever the number of rows."""
    key = F.concat(F.col("lang").cast("binary"), F.lit(b"\0"), F.col("prefix"))
    size = BITS

    def words(batches):
        for b in batches:
            bits = np.fromiter((_bit(k.as_py(), size) for k in b.column("key")), np.int64, b.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(bits >> 6), pa.array(np.left_shift(np.ones(len(bits), np.uint64), (bits & 63).astype(np.uint64)).view(np.int64))], names=["w", "m"])

    t = rows.select(key.alias("key")).mapInArrow(words, "w bigint, m bigint").groupBy("w").agg(F.bit_or("m").alias("m")).toArrow()
    out = np.zeros(size >> 6, np.int64)
    out[np.asarray(t["w"])] = np.asarray(t["m"])
    return out


def runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in their order, and how often each occurs."""
    s = np.sort(keys)
    at = np.flatnonzero(np.r_[len(s) > 0, s[1:] != s[:-1]]) if len(s) else np.zeros(0, np.int64)
    return s[at], np.diff(np.r_[at, len(s)])


def tally(lang: pa.Array, source: pa.Array, texts: pa.Array, known: int, width: int | None) -> pa.Table:
    """Counts of some documents (binary texts): lang, source, prefix, n as in ``_counted``, before the bitmap is asked."""
    plain = pa.array([t.as_py().translate(TERM_BYTES) for t in texts], pa.binary()).view(pa.string())
    lists = pc.ascii_split_whitespace(plain)
    terms, doc = lists.flatten().view(pa.binary()), pc.list_parent_indices(lists).to_numpy()
    # blanks at the ends of a text leave empty terms; terms shorter than the prefixes known were complete in an earlier level
    long = pc.greater_equal(pc.binary_length(terms), max(1, known))
    if not pc.all(long, min_count=0).as_py():
        terms, doc = terms.filter(long), doc[long.to_numpy(zero_copy_only=False)]
    code = (pc.binary_slice(terms, 0, width) if width else terms).dictionary_encode()
    size, at = max(1, len(code.dictionary)), code.indices.to_numpy()
    langs, sources = lang.dictionary_encode(), source.dictionary_encode()
    kinds = max(1, len(sources.dictionary))
    group = langs.indices.to_numpy().astype(np.int64) * kinds
    if width:
        once = runs(doc * size + at)[0]
        doc, at = once // size, once % size
    else:
        group += sources.indices.to_numpy()
    cells, n = runs(group[doc] * size + at)
    of = cells // size
    named = pa.repeat(pa.scalar(""), len(cells)) if width else sources.dictionary.take(pa.array(of % kinds))
    return pa.table({"lang": langs.dictionary.take(pa.array(of // kinds)), "source": named, "prefix": code.dictionary.take(pa.array(cells % size)), "n": pa.array(n, pa.int64())})


def _held(t: pa.Table, bits: np.ndarray, first: int | None) -> pa.Table:
    """The rows whose prefix, or its ``first`` bytes, the bitmap holds for their language."""
    lang = t["lang"].combine_chunks().dictionary_encode()
    key = (pc.binary_slice(t["prefix"], 0, first) if first else t["prefix"]).combine_chunks().dictionary_encode()
    size = max(1, len(key.dictionary))
    cells = lang.indices.to_numpy().astype(np.int64) * size + key.indices.to_numpy()
    pairs = runs(cells)[0]
    heads, keys = [x.encode() + b"\0" for x in lang.dictionary.to_pylist()], key.dictionary.to_pylist()
    at = np.fromiter((_bit(heads[p // size] + keys[p % size], 64 * len(bits)) for p in pairs.tolist()), np.int64, len(pairs))
    stays = (bits[at >> 6] >> (at & 63) & 1).astype(bool)
    return t.filter(pa.array(stays[np.searchsorted(pairs, cells)]))


def _counted(docs: DataFrame, bitmap: np.ndarray | None, known: int, width: int | None) -> DataFrame:
    """Counts over the terms whose first ``known`` bytes the bitmap holds: lang, prefix, n distinct documents by prefixes of at most
    ``width`` bytes; or, without ``width``, lang, source, prefix, n occurrences of the terms that the bitmap holds whole."""
    shared = None if bitmap is None else docs.sparkSession.sparkContext.broadcast(bitmap)
    first = known if width else None

    def run(batches):
        bits = None if shared is None else shared.value
        for b in batches:
            sizes = np.cumsum(pc.binary_length(b.column("text")).to_numpy())
            at = 0
            while at < b.num_rows:
                to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + HELD, "right")))
                part = b.slice(at, to - at)
                made = tally(part.column("lang"), part.column("source"), part.column("text"), known, width)
                yield from (made if bits is None else _held(made, bits, first)).to_batches()
                at = to

    slim = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    out = slim.mapInArrow(run, "lang string, source string, prefix binary, n bigint")
    counts = out.groupBy(*(["lang", "prefix"] if width else ["lang", "source", "prefix"])).agg(F.sum("n").alias("n"))
    made = stored(counts.filter(F.col("n") >= DOCUMENTS) if width else counts)
    if shared is not None:
        shared.destroy()
    return made


def kept_terms(docs: DataFrame) -> DataFrame:
    """lang, prefix (the bytes of a complete term) of terms in at least ``DOCUMENTS`` documents of the language; ``docs`` has lang, source, text
    without nulls. A prefix shorter than its level's width is a term that ends there; one as long as that is extended in the next level."""
    bitmap, known, width, kept = None, 0, FIRST, None
    while True:
        level = _counted(docs, bitmap, known, width)
        ended = F.length("prefix") < width
        whole = level.filter(ended).select("lang", "prefix")
        kept = whole if kept is None else kept.unionByName(whole)
        longer = level.filter(~ended)
        if longer.isEmpty():
            return stored(kept)
        bitmap, known, width = _bitmap(longer), width, GROWTH * width


def scaled(count, total):
    """1 + floor(10^9 * (count + 2) / total), by division in steps of three digits, as a product may not fit 64 bits; columns or arrays."""
    column = isinstance(count, Column)
    quotient = lambda a: F.call_function("div", a, total) if column else a // total
    rest = count + 2
    out = quotient(rest)
    for _ in range(3):
        rest = (rest % total) * 1000
        out = out * 1000 + quotient(rest)
    return out + 1


def difference(p, q):
    """floor((p - q)^2 / (p + q)) of whole numbers; p and q are at most about 10^9 + 1, so squares fit 64 bits."""
    return F.call_function("div", (p - q) * (p - q), p + q) if isinstance(p, Column) else (p - q) ** 2 // (p + q)


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (numbers of two sources, a < b), value: the sum over kept terms of the sources' differences.

    ``cells``: lang, term, k (number of the source), n. ``groups``: lang, k, total (N + 2 V), v.
    """
    sizes = groups.groupBy("lang").agg(F.max("k").alias("last"), F.max("v").alias("v"))
    sources = groups.select("lang", F.floor(F.col("k") / SOURCES).cast("int").alias("block"), "k", "total")
    chunked = cells.join(sizes, "lang").withColumn("chunk", F.pmod(F.xxhash64("term"), F.ceil(F.col("v") / TERMS)))
    block, last = F.floor(F.col("k") / SOURCES).cast("int"), F.floor(F.col("last") / SOURCES).cast("int")
    # a cell meets each block of sources of its language; a pair of blocks is compared chunk by chunk
    met = chunked.withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    rows = met.select("lang", "chunk", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "term", "k", "n")
    heads = groups.join(sizes.select("lang", "last", F.ceil(F.col("v") / TERMS).alias("chunks")), "lang").withColumn("own", block).withColumn("other", F.explode(F.sequence(F.lit(0), last)))
    heads = heads.withColumn("chunk", F.explode(F.when(F.col("chunks") > 0, F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)).otherwise(F.array().cast("array<bigint>"))))
    heads = heads.select("lang", "chunk", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), F.lit(None).cast("binary").alias("term"), "k", F.col("total").alias("n"))

    def compare(t: pa.Table) -> pa.Table:
        head = np.asarray(t["term"].is_null())
        k, n = t["k"].to_numpy(), t["n"].to_numpy()
        order = np.argsort(k[head])
        ids, totals = k[head][order], n[head][order]
        names, at = np.unique(t.filter(pa.array(~head))["term"].combine_chunks().dictionary_encode().indices, return_inverse=True)
        counts = np.zeros((len(ids), len(names)), np.int64)
        np.add.at(counts, (np.searchsorted(ids, k[~head]), at), n[~head])
        p = scaled(counts, totals[:, None])
        none = scaled(np.zeros(len(ids), np.int64), totals)
        x, y = (ids // SOURCES == z for z in (t["x"][0].as_py(), t["y"][0].as_py()))
        out = []
        for i in np.flatnonzero(x):
            js = np.flatnonzero(y & (ids > ids[i]))
            # relative to a term that both lack
            value = difference(p[i], p[js]).sum(axis=1) - len(names) * difference(none[i], none[js])
            out += [(int(ids[i]), int(ids[j]), int(v)) for j, v in zip(js, value, strict=True)]
        a, b, value = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"lang": pa.array([t["lang"][0].as_py()] * len(a), pa.string()), "a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()), "part": pa.array(value, pa.int64())})

    parts = rows.unionByName(heads).groupBy("lang", "chunk", "x", "y").applyInArrow(compare, "lang string, a int, b int, part bigint")
    summed = parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))
    one = lambda x: groups.select("lang", F.col("k").alias(x), F.col("total").alias(f"total_{x}"), "v")
    every = one("a").join(one("b").drop("v"), "lang").filter("a < b").join(summed, ["lang", "a", "b"], "left")
    lacking = difference(scaled(F.lit(0), F.col("total_a")), scaled(F.lit(0), F.col("total_b")))
    return every.select("lang", "a", "b", F.when(F.col("v") == 0, F.lit(0)).otherwise(F.coalesce("part", F.lit(0)) + F.col("v") * lacking).alias("value"))


def source_divergence(docs: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair`` has a row for each ordered pair of sources of a language, part ``term`` the ``TOP`` kept terms that a source uses most beyond its
    language. Null and empty texts have no terms, but their (lang, source) is a group; null languages and sources count as empty ones;
    repeated rows are documents of their own; equal values are ranked by the bytes of the item. Extra columns are not read; an empty
    table gives an empty result. A language without kept terms has pairs of value 0 and no terms.
    """
    slim = docs.select(*(whole_text(f"`{c}`").alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))))
    kept = kept_terms(slim)
    used = _counted(slim, _bitmap(kept), 0, None).join(kept, ["lang", "prefix"], "left_semi").withColumnRenamed("prefix", "term")
    used = stored(used)
    size = kept.groupBy("lang").agg(F.count("*").alias("v"))
    sums = used.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = slim.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(size, "lang", "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("v", F.lit(0)).alias("v"))
    total = (F.col("n") + 2 * F.col("v")).alias("total")
    groups = stored(groups.select("lang", "source", "n", "v", total, (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("k")))

    cells = used.join(groups.select("lang", "source", "k"), ["lang", "source"]).select("lang", "term", "k", "n")
    found = _pairs(cells, groups.select("lang", "k", "total", "v"))
    both = found.select("lang", F.explode(F.array(F.struct(F.col("a").alias("k"), F.col("b").alias("o")), F.struct(F.col("b").alias("k"), F.col("a").alias("o")))).alias("p"), "value").select("lang", "p.k", "p.o", "value")
    named = both.join(groups.select("lang", "k", "source"), ["lang", "k"]).join(groups.select("lang", F.col("k").alias("o"), F.col("source").alias("item")), ["lang", "o"])
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = named.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(ranks).alias("rank"))

    langs = groups.groupBy("lang").agg((F.sum("n") + 2 * F.max("v")).alias("lang_total"))
    in_lang = used.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    p, q = scaled(F.col("n"), F.col("total")), scaled(F.col("lang_n"), F.col("lang_total"))
    over = used.join(in_lang, ["lang", "term"]).join(groups.select("lang", "source", "total"), ["lang", "source"]).join(langs, "lang").select("lang", "source", F.col("term").cast("string").alias("item"), p.alias("p"), q.alias("q")).filter("p > q")
    terms = over.select("lang", "source", F.lit("term").alias("part"), "item", difference(F.col("p"), F.col("q")).alias("value")).withColumn("rank", F.row_number().over(ranks)).filter(F.col("rank") <= TOP)
    return pairs.unionByName(terms)
