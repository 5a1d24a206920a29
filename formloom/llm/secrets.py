"""Secret scans: credentials of known form, and weak candidates that stand near the parts that complete them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import read, written

#: The three base kinds, in the order in which ties are told.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
BASE = {"assign": (ASSIGN, 2, 6), "access": (ACCESS, 0, 20), "hex": (r"[0-9a-f]{24,}", 0, 24)}
#: Names of secrets that the base kinds do not take; those that end in an identifier's name are no identifiers.
OF_SECRET = r"(?:secret|shared|account|storage|primary|secondary)[_.-]?"
#: Parts of a credential that say little alone. An identifier or secret is group 1.
PARTS = {
    "id": rf"""(?i)(?:access[_-]?key[_-]?id|(?<!{OF_SECRET})access[_-]?key|client[_-]?id|account[_-]?(?:id|name)|user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.@-]{{4,}})""",
    "named": rf"""(?i)(?:{OF_SECRET}(?:access[_.-]?)?key|(?:private|signing|encryption)[_.-]?key)["']?\x20*[:=]\x20*["']?((?=[A-Za-z0-9+/_-]*[0-9])[A-Za-z0-9+/_-]{{16,}}={{0,2}})(?![A-Za-z0-9+/_=-])""",
    "key": r"""(?<![A-Za-z0-9+/_-])(?<!==)((?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}+={0,2})(?![A-Za-z0-9+/_=-])""",
    "endpoint": r"""(?i)((?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp|ssh)://[^\x00-\x20"'<>]{4,}|(?<![a-z0-9.-])(?![a-z0-9.-]*\.\.)[a-z0-9-][a-z0-9.-]*+(?<=[a-z0-9-]\.(?:amazonaws|azure|googleapis|cloudflarestorage)\.com))""",
}
#: Code points between parts that belong together, and the scope that they share: text without an empty line.
REACH = 400
SCOPE = r"\n[ \t\r]*\n"


def let(value: Column, body) -> Column:
    """The body of a value that it uses several times, worked out once."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, both) -> Column:
    """Running sums or the like of an array: rounds that reach twice as far each, so that no array is copied for each element."""
    rounds = F.when(F.size(values) > 1, F.sequence(F.lit(1), F.ceil(F.log2(F.size(values))).cast("int"))).otherwise(F.expr("cast(array() as array<int>)"))

    def further(acc: Column, _: Column) -> Column:
        v, far = acc["v"], acc["far"]
        return F.struct((far * 2).alias("far"), F.transform(v, lambda x, i: F.when(i >= far, both(x, F.get(v, i - far))).otherwise(x)).alias("v"))

    return let(values, lambda v: F.aggregate(rounds, F.struct(F.lit(1).alias("far"), v.alias("v")), further, lambda acc: acc["v"]))


def placed(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost matches that do not overlap, as (start, end, value, at, to), in code points and in bytes.

    Places are running sums of the lengths of the matches and of what lies between them. A value is group's, and ends its match.
    """
    whole, value = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    found = F.struct(whole.alias("whole"), value.alias("value"), F.split(text, pattern, -1).alias("between"))

    def places(f: Column) -> Column:
        before = F.slice(f["between"], F.lit(1), F.size(f["whole"]))
        upto = lambda size: running(F.zip_with(before, f["whole"], lambda b, w: size(b) + size(w)), lambda x, y: x + y)
        every = F.arrays_zip(f["whole"].alias("whole"), f["value"].alias("value"), upto(F.length).alias("end"), upto(F.octet_length).alias("to"))
        return F.transform(every, lambda m: F.struct((m["end"] - F.length(m["whole"])).alias("start"), m["end"].alias("end"), m["value"].alias("value"), (m["to"] - F.octet_length(m["whole"])).alias("at"), m["to"].alias("to")))

    return let(found, places)


def long_enough(least: int):
    """A test of one match; with a second parameter it would be given the place."""
    return lambda m: F.length(m["value"]) >= least


MATCH = "struct<start:int,end:int,value:string,at:int,to:int>"
NONE = f"cast(array() as array<{MATCH}>)"


def scan(docs: DataFrame, text: str) -> DataFrame:
    """All rows with `_fl_<kind>`: the matches of each base kind that keep their size, and of each part, in order.

    Each pattern runs on the texts that hold what it cannot do without.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("_fl_text", t)
    within = {"assign": r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]", "access": "AKIA[A-Z0-9]", "hex": "[0-9a-f]{24}", "id": r"(?i)(?:key|id|name|user|login)[\"']?\x20*[:=]", "named": r"(?i)key[\"']?\x20*[:=]", "key": "[A-Za-z0-9+/_=-]{20}", "endpoint": "://|\\.com"}
    for kind, (pattern, group, least) in BASE.items():
        found = F.filter(placed(F.col("_fl_text"), pattern, group), long_enough(least))
        out = out.withColumn(f"_fl_{kind}", F.when(F.col("_fl_text").rlike(within[kind]), found).otherwise(F.expr(NONE)))
    for kind, pattern in PARTS.items():
        # group 1 ends the match of an identifier, and is the match of the others
        found = F.transform(placed(F.col("_fl_text"), pattern, 1), lambda m: F.struct((m["end"] - F.length(m["value"])).alias("start"), m["end"].alias("end"), m["value"].alias("value"), (m["to"] - F.octet_length(m["value"])).alias("at"), m["to"].alias("to")))
        out = out.withColumn(f"_fl_{kind}", F.when(F.col("_fl_text").rlike(within[kind]), found).otherwise(F.expr(NONE)))
    breaks = F.when(F.col("_fl_text").rlike(SCOPE), F.transform(placed(F.col("_fl_text"), SCOPE), lambda m: m["start"])).otherwise(F.expr("cast(array() as array<int>)"))
    return out.withColumn("_fl_breaks", breaks).drop("_fl_text")


def linked(table: DataFrame) -> DataFrame:
    """(_fl_row, spans): the weak keys with an identifier or endpoint in reach, and the identifiers with such a key.

    An interval join: parts meet by row, scope and stretch of REACH code points, each key in its own stretch and the two
    beside it, so that no pair is out of reach by more than a stretch. What overlaps what, and the scope, are told by
    windows down and up the text. An identifier that is an access identifier is told as such and not again.
    """
    held = table.filter(F.size("_fl_key") + F.size("_fl_named") > 0)
    of = lambda kind, name: F.transform(F.col(f"_fl_{name}"), lambda m: F.struct(F.lit(kind).alias("kind"), *[m[c].alias(c) for c in ("start", "end", "value", "at", "to")]))
    breaks = F.transform("_fl_breaks", lambda b: F.struct(F.lit("break").alias("kind"), b.alias("start"), b.alias("end"), F.lit("").alias("value"), b.alias("at"), b.alias("to")))
    every = F.concat(of("base", "assign"), of("base", "hex"), *[of(k, k) for k in ("access", "endpoint", "id", "named", "key")], breaks)
    p = held.select("_fl_row", F.explode(every).alias("p")).select("_fl_row", "p.*")
    down, up = W.partitionBy("_fl_row").orderBy("start"), W.partitionBy("_fl_row").orderBy(F.desc("start"))

    def met(*kinds: str) -> Column:
        """Whether a part overlaps one of these kinds: one that begins before or with it ends within it, or one begins within it."""
        one = F.col("kind").isin(*kinds)
        before, after = F.max(F.when(one, F.col("end"))).over(down), F.min(F.when(one, F.col("start"))).over(up)
        return F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False))

    p = p.withColumns({"_named": met("base", "access", "endpoint"), "_key": met("base", "access", "endpoint", "id", "named"), "scope": F.count(F.when(F.col("kind") == "break", 1)).over(down), "access": F.coalesce(F.max(F.when(F.col("kind") == "access", F.col("start"))).over(down) == F.col("start"), F.lit(False))})
    free = ((F.col("kind") == "named") & ~F.col("_named")) | ((F.col("kind") == "key") & ~F.col("_key"))
    part = F.when(free, "key").when(F.col("kind").isin("id", "access"), "id").when(F.col("kind") == "endpoint", "endpoint")
    p = written(p.withColumn("part", part).filter("part is not null").drop("_named", "_key", "kind"), "secrets-parts")
    cell = F.floor(F.col("start") / REACH)
    keys = p.filter("part = 'key'").withColumn("cell", F.explode(F.array(*[cell + d for d in (-1, 0, 1)])))
    others = p.filter("part <> 'key'").withColumn("cell", cell).withColumnsRenamed({c: f"o_{c}" for c in ("part", "start", "end", "value", "at", "to", "access")})
    near = keys.join(others, ["_fl_row", "scope", "cell"]).filter((F.abs(F.col("start") - F.col("o_start")) <= REACH) & (F.col("value") != F.col("o_value")))
    span = lambda kind, pre: F.struct(F.col(f"{pre}start").alias("start"), F.lit(RANK[kind]).alias("rank"), F.lit(kind).alias("kind"), *[F.col(f"{pre}{c}").alias(c) for c in ("end", "at", "to")])
    both = near.select("_fl_row", F.explode(F.array(span("linked", ""), F.when((F.col("o_part") == "id") & ~F.col("o_access"), span("identifier", "o_")))).alias("s")).filter("s is not null")
    return both.groupBy("_fl_row").agg(F.collect_set("s").alias("_fl_linked"))


RANK = {"assign": 0, "access": 1, "hex": 2, "linked": 3, "identifier": 4}


def told(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


SPAN = "struct<start:int,rank:int,kind:string,end:int,at:int,to:int>"


def spans_of(kind: str) -> Column:
    return F.transform(f"_fl_{kind}", lambda m: F.struct(m["start"].alias("start"), F.lit(RANK[kind]).alias("rank"), F.lit(kind).alias("kind"), *[m[c].alias(c) for c in ("end", "at", "to")]))


def find_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """All columns of docs, or those to keep, with n_assign, n_access, n_hex, base_spans and spans (arrays of start, rank, kind, end in code points, and at and to, the same in bytes of UTF-8).

    Null and empty texts hold none; equal rows are scanned each; null ids are kept; texts and keys of any length are
    scanned whole; no rows give none. Columns of docs that
    are named like those added give way to them. An access identifier that is linked as a part is told once, as access.
    """
    keep = [c for c in keep or docs.columns if c not in ("n_assign", "n_access", "n_hex", "base_spans", "spans")]
    found = scan(docs.select(*[F.col(c).alias(f"_fl_keep_{c}") for c in keep], F.col(text).alias("_fl_in")), "_fl_in").drop("_fl_in")
    table = written(found.withColumn("_fl_row", F.monotonically_increasing_id()), "secrets")
    base = F.concat(*[spans_of(k) for k in BASE])
    more = F.coalesce("_fl_linked", F.expr(f"cast(array() as array<{SPAN}>)"))
    out = table.join(linked(table), "_fl_row", "left")
    return out.select(*[F.col(f"_fl_keep_{c}").alias(c) for c in keep], *[F.size(f"_fl_{k}").cast("long").alias(f"n_{k}") for k in BASE], F.array_sort(base).alias("base_spans"), F.array_sort(F.concat(base, more)).alias("spans"))


def redact(text: Column, spans: Column, by: str = "[secret]") -> Column:
    """The text with every span replaced; spans that overlap are replaced once. Spans are find_secrets()', in order.

    What lies between is cut out by its bytes, each of which is read once.
    """
    data = F.struct(text.cast("binary").alias("text"), spans.alias("spans"), running(F.transform(spans, lambda s: s["to"]), F.greatest).alias("upto"))

    def cut(d: Column) -> Column:
        before = lambda i: F.when(i > 0, F.get(d["upto"], i - 1)).otherwise(0)
        piece = lambda a, b: F.substring(d["text"], a + 1, b - a).cast("string")
        parts = F.transform(d["spans"], lambda s, i: F.when(s["at"] >= before(i), F.concat(piece(before(i), s["at"]), F.lit(by))).otherwise(""))
        return F.concat(F.array_join(parts, ""), piece(F.element_at(d["upto"], -1), F.octet_length(d["text"])))

    return F.when(F.size(spans) == 0, text).otherwise(let(data, cut))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = find_secrets(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(told(F.col("base_spans")), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))
