"""URL filter: host and path rules, then a blocked Bloom filter over listed canonical URLs and an exact join behind it.

All work is DataFrame expressions. The filter is a table of blocks, eight 64-bit words each; a URL sets one bit in each
word of one block. Possible hits go to a join on the canonical URL, which removes false positives, so the verdict never
depends on the filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locuswise.llm.common import stored

#: bits a listed URL gets in the filter, and the size of a block
BITS_PER_URL, WORDS = 16, 8
#: a filter of at most so many bytes is broadcast; a larger one is joined on the block number
BROADCAST_BYTES = 64 << 20

# The rules of the query, as (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Words of hosts whose pages are listed by the query.
LISTED_WORDS = ("casino", "poker", "betting", "pills")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    tail = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    place = F.regexp_extract(tail, r"^([^?#]*)", 1)
    host = F.substring_index(place, "/", 1)
    return ascii_lower(host), F.substr(place, F.char_length(host) + 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` and ``m.``, path without ``.html``, ``index`` and closing slashes; scheme, query and fragment are gone."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(F.regexp_replace(path, r"(index)?\.html?$", ""), "/+$", ""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; both null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _place(url: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block number and, per word, the URL's bit."""
    return F.pmod(F.xxhash64(url), F.lit(blocks)), [F.expr(f"shiftleft(1L, CAST(pmod(shiftright(h, {6 * i}), 64) AS INT))") for i in range(WORDS)]


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """One row per block in use (block, w0 .. w7) over the column ``canonical`` of ``listed``."""
    block, bits = _place(F.col("canonical"), blocks)
    keyed = listed.select(block.alias("block"), F.xxhash64(F.lit(1), "canonical").alias("h"))
    return keyed.groupBy("block").agg(*(F.bit_or(b).alias(f"w{i}") for i, b in enumerate(bits)))


def with_maybe(urls: DataFrame, bloom: DataFrame, blocks: int, broadcast: bool) -> DataFrame:
    """``urls`` (with ``canonical``) plus ``maybe``: all bits of the URL are set in the filter."""
    block, bits = _place(F.col("canonical"), blocks)
    keyed = urls.withColumns({"block": block, "h": F.xxhash64(F.lit(1), "canonical")})
    hit = None
    for i, b in enumerate(bits):
        one = F.col(f"w{i}").bitwiseAND(b) != 0
        hit = one if hit is None else hit & one
    joined = keyed.join(F.broadcast(bloom) if broadcast else bloom, "block", "left")
    return joined.select(*urls.columns, F.coalesce(hit, F.lit(False)).alias("maybe"))


def url_verdicts(pages: DataFrame, listed: DataFrame, rules=RULES, *, page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, canonical, listed, verdict for each row of ``pages``.

    ``listed`` has a column ``canonical``; null and empty entries list nothing. Rules come first (the longest that fits);
    other URLs are blocked if listed, else allowed; ``listed`` is false where a rule has decided. A null URL or one without
    ``://`` has an empty host and path, fits no rule, is not listed and so is allowed. Repeated rows are judged each; extra
    columns are not read; an empty table gives an empty result.
    """
    host, path = host_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "ruled": verdict, "canonical": canonical(F.col("host"), F.col("path"))})
    listed = stored(listed.select("canonical").filter("canonical IS NOT NULL AND canonical <> ''").distinct())
    blocks = max(1, -(-listed.count() * BITS_PER_URL // (64 * WORDS)))
    free = F.expr("ruled IS NULL AND canonical <> ''")
    checked = with_maybe(rows.filter(free), bloom_filter(listed, blocks), blocks, blocks * (8 * WORDS + 8) <= BROADCAST_BYTES)
    exact = checked.filter("maybe").join(listed.withColumn("listed", F.lit(True)).hint("shuffle_hash"), "canonical", "left")
    plain = rows.filter(~free).unionByName(checked.filter("NOT maybe").drop("maybe")).withColumn("listed", F.lit(False))
    out = exact.drop("maybe").withColumn("listed", F.coalesce("listed", F.lit(False))).unionByName(plain)
    return out.select(
        "page_id", "host", "path", "rule", "canonical", "listed",
        F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"),
    )


def listed_urls(pages: DataFrame, words=LISTED_WORDS, *, url: str = "url") -> DataFrame:
    """Canonical URLs of pages on hosts that have one of ``words`` in their name: the list of the query."""
    host, path = host_path(F.col(url))
    rows = pages.select(host.alias("host"), path.alias("path"))
    return rows.filter(F.col("host").rlike("|".join(words))).select(canonical(F.col("host"), F.col("path")).alias("canonical"))
