"""Judges URLs by rules for hosts and paths, and by a list of blocked places.

A place is a host and the start of a path. It fits a URL whose host is that host or a subdomain of
it and whose path starts with that path. All places, those of the rules and those of the list, stand
in a blocked Bloom filter (one 512-bit block and eight bits a key). The few places that a URL could
match are probed there; what passes goes to a hash join with the places themselves, which removes
the filter's false positives.

The host is what stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, with
A-Z in lower case; the path goes on to ``?``, ``#`` or the end. A null URL and one without ``://``
have an empty host and path and fit nothing. The longest rule decides; of equally long ones the one
that sorts first. Where no rule fits, listed places are blocked and the others allowed. Each row gives
one row; repeated rows repeat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits of the filter for each listed place, in blocks of 512. Up to so many blocks (16 MiB of bits, a million places) are sent
#: to all executors; the blocks of a longer list are joined as Spark sees fit.
BITS_A_PLACE, BLOCKS_SENT = 128, 262_144
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Odd factors that pick one bit in each of a block's eight words.
_FACTORS = [0x47B6137B44974D91, 0x8824AD5BA2B7289D, 0x705495C72DF1424B, 0x9EFC49475C6BFB31, 0x2DF1424B9EFC4947, 0x5C6BFB3144974D91, 0x7289D47B6137B449, 0x1424B9EFC4947C6B]

PLACES = "verdict string, rule string, host string, path string"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL."""
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, _PARTS, 1), _UPPER, _LOWER), F.regexp_extract(text, _PARTS, 2)


def places(spark: SparkSession, rules: list[tuple[str, str]], listed: list[str]) -> DataFrame:
    """Rules (verdict, ``host/path``) and blocked places (``host/path``) as a table; a listed place has no rule."""
    rows = [(verdict, rule, rule.partition("/")[0], "/" + rule.partition("/")[2]) for verdict, rule in rules]
    rows += [("block", None, place.partition("/")[0], "/" + place.partition("/")[2]) for place in listed]
    return spark.createDataFrame(rows, PLACES)


def filter_blocks(n_places: int) -> int:
    """Blocks of a filter for so many places."""
    return max(1, -(-n_places * BITS_A_PLACE // 512))


def _bits(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a key, and the eight words of its mask."""
    hashed = F.xxhash64(key)
    block = F.pmod(hashed, F.lit(blocks)).cast("int")
    spread = F.xxhash64(key, F.lit(1))
    masks = [F.expr("1L") for _ in _FACTORS]
    for number, factor in enumerate(_FACTORS):
        # a 31-bit product of the key's second hash picks the bit; no step overflows
        part = F.pmod(spread, F.lit((1 << 31) - 1)) * F.lit(factor % (1 << 31))
        masks[number] = F.call_function("shiftleft", F.expr("1L"), F.pmod(F.shiftrightunsigned(part, 20), F.lit(64)).cast("int"))
    return block, masks


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter's blocks that are not empty: ``block`` and eight words, ``blocks`` rows at most."""
    block, masks = _bits(F.col("key"), blocks)
    rows = keys.select(block.alias("block"), *[mask.alias(f"w{n}") for n, mask in enumerate(masks)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{n}").alias(f"w{n}") for n in range(len(masks))])


def judge_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Per row: id, host, path, rule, verdict. ``listed`` has the columns of ``PLACES``."""
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col), host.alias("__host"), path.alias("__path"))
    place = listed.select("verdict", "rule", "host", "path", F.concat("host", "path").alias("key"))
    # how deep hosts go and how long paths are in the list: no other part of a URL can match
    shape = place.agg(F.max(F.size(F.split("host", r"\."))), F.sort_array(F.collect_set(F.length("path"))), F.count("*")).head()
    labels, lengths, blocks = shape[0] or 0, shape[1] or [], filter_blocks(shape[2])

    urls = rows.where("__host <> ''").select("__host", "__path").distinct()
    tail = F.slice(F.reverse(F.split("__host", r"\.")), 1, max(labels, 1))
    suffixes = F.transform(F.sequence(F.lit(1), F.size(tail)), lambda n: F.array_join(F.reverse(F.slice(tail, 1, n)), "."))
    starts = F.filter(F.array(*[F.when(F.length("__path") >= n, F.substring("__path", 1, n)) for n in lengths] or [F.lit(None).cast("string")]), lambda x: x.isNotNull())
    probes = urls.withColumn("suffix", F.explode(suffixes)).withColumn("start", F.explode(starts))
    probes = probes.select("__host", "__path", F.concat("suffix", "start").alias("key"))

    block, masks = _bits(F.col("key"), blocks)
    filled = bloom_blocks(place, blocks)
    filled = F.broadcast(filled) if blocks <= BLOCKS_SENT else filled
    passed = F.lit(True)
    for number in range(len(_FACTORS)):
        passed = passed & (F.col(f"w{number}").bitwiseAND(F.col(f"m{number}")) == F.col(f"m{number}"))
    probes = probes.select("*", block.alias("block"), *[mask.alias(f"m{n}") for n, mask in enumerate(masks)])
    possible = probes.join(filled, "block").where(passed).select("__host", "__path", "key")

    found = possible.join(place.select("key", "verdict", "rule"), "key")
    size = F.when(F.col("rule").isNotNull(), F.length("key"))
    best = F.min(F.when(F.col("rule").isNotNull(), F.struct((-size).alias("order"), "rule", "verdict")))
    verdicts = found.groupBy("__host", "__path").agg(best.alias("best"), F.bool_or(F.col("rule").isNull() & (F.col("verdict") == "block")).alias("on_list"))
    judged = rows.join(verdicts, ["__host", "__path"], "left")
    return judged.select(
        id_col,
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.when(F.col("on_list"), "block"), F.lit("allow")).alias("verdict"),
    )
