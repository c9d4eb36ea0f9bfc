"""Operator 4: host and path rules by a cascade of Bloom filters, in DataFrame functions only.

Every url yields one key for each shape (labels of the host, characters of the path) that
the rules have.  These keys are the universe.  Level 1 encodes the listed keys, level 2 the
keys of the universe that level 1 lets pass although they are not listed, level 3 the listed
keys that level 2 lets pass, and so on until a level lets nothing wrong pass.  The number of
levels a key passes says exactly, for keys of the universe, whether it is listed.  No row is
joined with the rules.

The levels reach the tasks as literals.  Their size follows the listed keys (the levels from
the second on have as few keys as the false-positive rate of the first allows) and is
checked: a level beyond `MAX_BITS` raises ValueError.  The caller then gives `parts`, by which
the list is split by key hash into that many cascades; the query leaves it at 1.

Defined cases: a null url or one without `://` has empty host and path and fits no rule; an
empty table gives an empty result; repeated rows give repeated rows; of two rules that fit,
the longer wins, at equal length the one with the longer host; of rules with the same host and path the
last counts; rules whose path is not empty and has no leading `/` fit no url; without rules every url gets the default.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablehouse.llm.common import prepare, stored

#: (action, host, path)
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
MAX_BITS = 1 << 25
HASHES = 3


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first `://`, and path; both empty where there is none."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(text, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(text, pattern, 2)


def _bit(key: Column, level: int, hash_no: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(hash_no)), F.lit(bits))


@dataclass(frozen=True)
class Level:
    bits: int
    words: tuple[int, ...]

    def passes(self, key: Column, level: int) -> Column:
        words = F.array(*[F.lit(w) for w in self.words])
        hit = F.lit(True)
        for k in range(HASHES):
            at = _bit(key, level, k, self.bits)
            hit = hit & (F.getbit(F.get(words, (at / 64).cast("int")), F.pmod(at, F.lit(64)).cast("int")) == 1)
        return hit


def _level(keys: DataFrame, level: int, rate: float) -> Level:
    """A Bloom filter over `keys`: its set bits are folded into 64-bit words before they are read."""
    n = keys.count()
    bits = 64 * max(1, math.ceil(-n * math.log(rate) / math.log(2) ** 2 / 64))
    if bits > MAX_BITS:
        raise ValueError(f"{bits} bits for {n} keys; split the list into more parts")
    at = keys.select(F.explode(F.array(*[_bit(F.col("key"), level, k, bits) for k in range(HASHES)])).alias("at"))
    words = at.groupBy((F.col("at") / 64).cast("int").alias("i")).agg(F.expr("bit_or(shiftleft(1L, cast(pmod(at, 64) as int)))").alias("w"))
    filled = [0] * (bits // 64)
    for row in words.collect():  # bits / 64 rows at most, checked above
        filled[row.i] = row.w
    return Level(bits, tuple(filled))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether a key of the universe is listed: the first level that stops it decides."""
        out = F.lit(len(self.levels) % 2 == 1)
        for i in range(len(self.levels), 0, -1):
            out = F.when(self.levels[i - 1].passes(key, i), out).otherwise(F.lit(i % 2 == 0))
        return out


def build(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade for the keys `listed` (column key) over the distinct keys `universe` (column key, column listed)."""
    yes, no = listed, universe.filter(~F.col("listed")).select("key")
    n_yes, n_no = yes.count(), no.count()
    if not n_yes:
        return Cascade(())
    rate = min(0.5, n_yes / (2 * n_no)) if n_no else 0.5
    levels: list[Level] = []
    inside, outside = yes, no
    while True:
        levels.append(_level(inside, len(levels) + 1, rate if not levels else 0.5))
        wrong = outside.filter(levels[-1].passes(F.col("key"), len(levels)))
        if wrong.isEmpty():
            return Cascade(tuple(levels))
        inside, outside = wrong, inside


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, default: str = "allow", parts: int = 1) -> DataFrame:
    """`pages` (page_id, url) with host, path, the longest fitting rule and its verdict.

    `parts` splits a long list by key hash; every part has cascades of its own.
    """
    spark = prepare(pages.sparkSession)
    host, path = host_path(F.col("url"))
    urls = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    rules = list({h + p: (a, h, p) for a, h, p in rules if p[:1] in ("", "/")}.values())
    if not rules:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    shapes = sorted({(h.count(".") + 1, len(p)) for _, h, p in rules})
    texts = [F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, length)) for labels, length in shapes]
    hosts = [F.length(F.substring_index("host", ".", -labels)) for labels, _ in shapes]
    rule = F.explode(F.array(*[F.struct(F.lit(h + p).alias("key"), F.lit(a).alias("action")) for a, h, p in rules]))
    listed = spark.range(1).select(rule.alias("r")).select("r.key", "r.action")
    # the universe, once per distinct key; the short list is a literal set in the same scan
    of = F.create_map(*[x for a, h, p in rules for x in (F.lit(h + p), F.lit(a))])
    keys = urls.select(F.explode(F.array(*texts)).alias("key")).distinct()
    universe = stored(keys.withColumn("action", F.try_element_at(of, F.col("key"))), "url-keys")
    cascades = {}
    for action in sorted({a for a, _, _ in rules}):
        for part in range(parts):
            mine = F.pmod(F.xxhash64("key", F.lit(-1)), F.lit(parts)) == part
            cascades[action, part] = build(
                listed.filter((F.col("action") == action) & mine).select("key"),
                universe.filter(mine).withColumn("listed", F.coalesce(F.col("action") == action, F.lit(False))))
    found = []
    for text, width in zip(texts, hosts, strict=True):
        for (action, part), cascade in cascades.items():
            mine = F.pmod(F.xxhash64(text, F.lit(-1)), F.lit(parts)) == part
            hit = (F.col("host") != "") & mine & cascade.holds(text)
            found.append(F.when(hit, F.struct(F.length(text).alias("n"), width.alias("h"), text.alias("rule"), F.lit(action).alias("action"))))
    best = F.array_max(F.array_compact(F.array(*found)))
    return urls.withColumn("best", best).select(
        "page_id", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce(F.col("best.action"), F.lit(default)).alias("verdict"))


SQL = """
with u as (
  select page_id,
    case when position('://' in url) > 0 then
      translate(regexp_extract(substr(url, position('://' in url) + 3), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
      else '' end as host,
    case when position('://' in url) > 0 then
      regexp_extract(substr(url, position('://' in url) + 3), '^[^/?#]*([^?#]*)', 1) else '' end as path
  from pages),
r as (select * from (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                            ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')) t(action, h, p))
select page_id, host, path,
  (select r.h || r.p from r where (host = r.h or ends_with(host, '.' || r.h)) and starts_with(path, r.p)
   order by length(r.h || r.p) desc, length(r.h) desc limit 1) as rule,
  coalesce((select r.action from r where (host = r.h or ends_with(host, '.' || r.h)) and starts_with(path, r.p)
   order by length(r.h || r.p) desc, length(r.h) desc limit 1), 'allow') as verdict
from u
"""
