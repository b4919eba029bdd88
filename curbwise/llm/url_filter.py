"""URL filters: a sort-merge range join of urls with nested host and path rules.

A host turned round label by label ("www.example.com" -> "com.example.www.")
makes a rule's host and all its subdomains one interval of sorted keys,
["com.example.", "com.example/"); with its path behind it, a rule is an interval
of the keys of one host, ["com.example./en/", "com.example./en0"). Intervals of
either kind nest or are disjoint. A sweep over their sorted ends keeps a stack of
the active ones and leaves at each boundary the innermost one from there on: one
value a boundary, two boundaries an interval, however deep the rules nest.

Urls and boundaries are sorted together twice. In the first sweep a url takes
over its innermost host that has rules; that host and the hosts above it, each
with the url's path, are its keys in the second sweep, where each key takes over
its innermost, which is its longest, rule. The longest of a url's rules wins.

Urls are dealt to sorted ranges by a hash of the row, so one host with a third
of all urls spreads evenly; both sweeps and the choice of the winner run inside
a range, after one shuffle. Every range gets all boundaries, at most four a rule,
so rows of boundaries are ranges times rules. The list itself comes from the
driver: its memory and time there are those of sorting it, and it has no limit.

Cases: a null url, or one without ``://``, has an empty host and path and gets
the default verdict; rules that repeat count once, and of an allow and a block
rule with one text allow wins; very long urls are judged whole; repeated rows are
judged each; an empty table gives an empty result; further columns pass through
``judge`` whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from curbwise.llm.common import ascii_lower, free_name

_HIT = "struct<rule:string,verdict:string>"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for the host, its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    @property
    def key(self) -> str:
        return ".".join(reversed(self.host.split("."))) + "."


def parse_rule(line: str) -> Rule:
    """"block example.com/en/" -> Rule; the path starts at the first slash."""
    verdict, _, where = line.partition(" ")
    host, slash, path = where.partition("/")
    if verdict not in ("allow", "block") or not host:
        raise ValueError(f"not a rule: {line!r}")
    return Rule(verdict, host, slash + path)


def boundaries(prefixes: dict[str, object]) -> list[tuple[bytes, object]]:
    """Sorted (key, value): from each start or end of a prefix's interval on, the value of the innermost active prefix, or None."""
    ends = []
    for prefix, value in prefixes.items():
        k = prefix.encode()
        ends += [(k, 1, value), (k[:-1] + bytes([k[-1] + 1]), 0, None)]
    out: dict[bytes, object] = {}
    stack: list[object] = []
    for at, start, value in sorted(ends, key=lambda e: e[:2]):  # what ends at a key goes before what starts there
        stack.append(value) if start else stack.pop()
        out[at] = stack[-1] if stack else None
    return list(out.items())


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    u = F.coalesce(url, F.lit(""))
    at = F.instr(u, "://")
    return F.when(at > 0, F.substring(u, at + 3, F.length(u))).otherwise("")


def host_key(host: Column) -> Column:
    """Labels turned round, each ended by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def judge(pages: DataFrame, rules: list[Rule], url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with columns host, path, rule (null without one) and verdict at the end."""
    spark = pages.sparkSession
    host, path, rule, verdict = (free_name(pages.columns, n) for n in ("host", "path", "rule", "verdict"))
    row = F.struct(*[F.col(f"`{c}`") for c in pages.columns])
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    urls = pages.select(F.monotonically_increasing_id().alias("n"), row.alias("row"), host_of(F.col(f"`{url}`")).alias("h"),
                        path_of(F.col(f"`{url}`")).alias("p"))
    kind = urls.schema["row"].dataType
    none = lambda t: F.lit(None).cast(t)
    urls = urls.select("n", F.pmod(F.xxhash64("n"), F.lit(ranges)).alias("range"), "row", "h", "p",
                       host_key(F.col("h")).cast("binary").alias("key"), none("string").alias("node"),
                       none("binary").alias("key2"), none(_HIT).alias("hit"))

    ordered = sorted(set(rules), key=lambda r: (r.verdict, r.text), reverse=True)  # the last one of a text stays
    hosts = spark.createDataFrame(
        [(bytearray(k), v or "", None, None) for k, v in boundaries({r.key: r.key for r in ordered})],
        f"key binary, node string, key2 binary, hit {_HIT}")
    paths = spark.createDataFrame(
        [(None, None, bytearray(k), v or (None, None)) for k, v in boundaries({r.key + r.path: (r.text, r.verdict) for r in ordered})],
        f"key binary, node string, key2 binary, hit {_HIT}")
    marks = hosts.unionAll(paths).select(
        none("long").alias("n"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(ranges - 1).cast("long"))).alias("range"),
        none(kind).alias("row"), none("string").alias("h"), none("string").alias("p"), "key", "node", "key2", "hit")

    # a boundary at a url's key counts for it: marks first
    upto = lambda key: (Window.partitionBy("range").orderBy(key, F.col("n").isNotNull())
                        .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    swept = urls.unionAll(marks).withColumn("node", F.last("node", ignorenulls=True).over(upto("key")))
    swept = swept.filter("n IS NOT NULL OR key2 IS NOT NULL")
    labels = F.split("node", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda i: F.array_join(F.slice(labels, F.lit(1), i), "."))
    asked = F.when(F.col("n").isNull(), F.array("key2")).when(
        F.col("node") != "", F.transform(above, lambda a: F.concat(a, F.lit("."), F.col("p")).cast("binary")))
    swept = swept.select("n", "range", "row", "h", "p", "hit", F.explode_outer(asked).alias("key2"))
    swept = swept.withColumn("hit", F.last("hit", ignorenulls=True).over(upto("key2"))).filter("n IS NOT NULL")
    longest = Window.partitionBy("range", "n").orderBy(
        F.coalesce(F.length("hit.rule"), F.lit(-1)).desc(), F.length(F.substring_index("hit.rule", "/", 1)).desc())
    best = swept.withColumn("place", F.row_number().over(longest)).filter("place = 1")
    return best.select("row.*", F.col("h").alias(host), F.col("p").alias(path), F.col("hit.rule").alias(rule),
                       F.coalesce(F.col("hit.verdict"), F.lit(default)).alias(verdict))
