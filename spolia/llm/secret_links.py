"""Secret scan with multipart credential linking.

Strong findings stand alone: assignments of secrets, access key identifiers and long hexadecimal strings.  Weak
candidates (user names and other identifiers, assignments under doubtful names and random-looking strings, addresses of
services) are reported only where complementary parts co-occur: all candidates of a text are intervals, scopes end at
blank lines, and within a scope each weak candidate is joined with the intervals that are at most `reach` characters
away, from the end of the one to the start of the other: an equi-join on the stretches of SPAN characters they meet,
then a comparison of the ends.  A weak secret needs an identifier or an endpoint there, a weak identifier a secret, an endpoint both.

Matches are located without Python: the pieces between the matches give their lengths, and running sums the positions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spolia.llm.common import DOCUMENT_COLUMNS, filled, written

REACH = 256
SPAN = 1024
MASK = "[secret]"
_VALUE = r"""["']?\x20*[:=]\x20*["']?"""

# What the scan looks for; the last entries of each are the part of a credential and whether it stands alone.
KINDS = (
    ("assign", r"(?i:password|passwd|secret|token|api_?key)" + _VALUE + r"([A-Za-z0-9+/_.=-]+)", "secret", True),
    ("access", r"(AKIA[A-Z0-9]{16,})", "id", True),
    ("hex", r"([0-9a-f]{24,})", "secret", True),
    ("id", r"(?i:user(?:_?name|_?id)?|login|account|client_?id|(?:access_)?key_?id)" + _VALUE + r"([A-Za-z0-9_.@-]{3,})", "id", False),
    ("key", r"(?i:pwd|pass(?:phrase)?|credentials?|auth|private_?key)" + _VALUE + r"([A-Za-z0-9+/_.=-]{6,})", "secret", False),
    ("random", r"(?<![A-Za-z0-9+/_=-])([A-Za-z0-9+/_=-]{20,})", "secret", False),
    ("endpoint", r"((?i:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|mongodb|amqp|s3)://[^\x20\x09-\x0D\"'<>]{3,})", "endpoint", False),
)
BREAK = r"(\n[\x20\t]*\n)"
ORDER = {kind: k for k, (kind, *_) in enumerate(KINDS)}


def _matches(kind: str, pattern: str) -> Column:
    """One entry per match: its number, the characters before it since the last one, its length, whether it counts."""
    text, rx = F.col("text"), F.lit(pattern)
    parts = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, rx, F.lit(0)).alias("match"),
        F.regexp_extract_all(text, rx, F.lit(1)).alias("value"),
    )

    def entry(part: Column, number: Column) -> Column:
        value = part["value"]
        counts = F.lit(True)
        if kind == "assign":
            counts = F.length(value) >= 6
        if kind == "random":
            counts = value.rlike("[0-9]") & value.rlike("[A-Z]") & value.rlike("[a-z]")
        return F.struct(
            F.lit(kind).alias("kind"), number.alias("number"), F.length(part["gap"]).alias("gap"),
            F.length(part["match"]).alias("size"), counts.alias("counts"),
        )

    found = F.filter(F.transform(parts, entry), lambda e: e["size"].isNotNull())
    return F.when(text.rlike(pattern), found)


def _stretches(low: Column, high: Column) -> Column:
    """Numbers of the stretches of SPAN characters from `low` to `high`, a row each."""
    return F.explode(F.sequence(F.floor(low / SPAN), F.floor(high / SPAN)))


def intervals(df: DataFrame, key: str = "doc_id", reach: int = REACH) -> DataFrame:
    """`key`, `mark`, `kind`, `start`, `end`, `found`: every candidate of every text and whether it is reported.

    `mark` is a hash of the text; rows with equal keys and texts are one text, and the entry of kind "row" of
    each counts them in `copies`.  Null counts as empty.
    """
    rows = df.select(F.col(key).alias("key"), filled().alias("text")).withColumn("mark", F.xxhash64("text"))
    # The entry of the row itself; typed like the others.
    itself = F.array(F.struct(F.lit("row").alias("kind"), F.lit(0).alias("number"), F.lit(0).alias("gap"), F.lit(0).alias("size"), F.lit(True).alias("counts")))
    weak = F.coalesce(*[F.col(f"of_{kind}") for kind, *_, strong in KINDS if not strong])
    rows = rows.withColumns({f"of_{kind}": _matches(kind, pattern) for kind, pattern, *_ in KINDS})
    entries = [F.coalesce(F.col(f"of_{kind}"), F.slice(itself, 1, 0)) for kind, *_ in KINDS]
    breaks = F.coalesce(F.when(weak.isNotNull(), _matches("break", BREAK)), F.slice(itself, 1, 0))
    events = rows.select("key", "mark", F.explode(F.concat(itself, *entries, breaks)).alias("e")).select("key", "mark", "e.*")
    events = events.groupBy("key", "mark", "kind", "number", "gap", "size", "counts").agg(F.count("*").alias("copies"))

    text = ["key", "mark"]
    line = Window.partitionBy(*text, "kind").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(line)
    placed = events.withColumn("end", end).withColumn("start", F.col("end") - F.col("size")).where("counts")

    part = F.lit(None).cast("string")
    for kind, _, role, _ in KINDS:
        part = F.when(F.col("kind") == kind, role).otherwise(part)
    strong = F.col("kind").isin([kind for kind, *_, alone in KINDS if alone])
    order = Window.partitionBy(*text).orderBy("start", "end", "kind")
    # The rows after one are those before it in the reverse order; a frame up to the last row is computed anew for each row.
    back = Window.partitionBy(*text).orderBy(F.desc("start"), F.desc("end"), F.desc("kind"))
    before, after = order.rowsBetween(Window.unboundedPreceding, -1), back.rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumns({
        "part": part, "strong": strong,
        "scope": F.sum((F.col("kind") == "break").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)),
        "covered": F.coalesce(F.max(F.when(strong, F.col("end"))).over(before) > F.col("start"), F.lit(False))
        | F.coalesce(F.min(F.when(strong, F.col("start"))).over(after) < F.col("end"), F.lit(False)),
    }).where("strong or not covered")
    names = [*text, "kind", "start", "end"]
    placed = written(placed.select(*names, "part", "strong", "scope", "copies"), "candidates")
    has_part = F.col("part").isNotNull()
    weak = placed.where(~F.col("strong") & has_part).select(*names, "scope", _stretches(F.col("start") - reach, F.col("end") + reach).alias("stretch"))
    others = placed.where(has_part).withColumn("stretch", _stretches(F.col("start"), F.col("end")))
    others = others.select(*[F.col(c).alias(f"{c}_o") for c in (*text, "scope", "stretch", "start", "end", "part")])
    near = F.col("key").eqNullSafe(F.col("key_o")) & (F.col("start_o") <= F.col("end") + reach) & (F.col("end_o") >= F.col("start") - reach)
    for c in ("mark", "scope", "stretch"):
        near = near & (F.col(c) == F.col(f"{c}_o"))
    has = [F.max(F.col("part_o") == role).alias(f"has_{role}") for role in ("id", "secret", "endpoint")]
    # Each weak candidate meets itself, so none is lost; its own part decides nothing.
    met = weak.join(others, near).groupBy(*names).agg(*has)
    linked = (
        F.when(part == "secret", F.col("has_id") | F.col("has_endpoint"))
        .when(part == "id", F.col("has_secret")).otherwise(F.col("has_id") & F.col("has_secret"))
    )
    met = met.select(*names, F.lit(False).alias("strong"), linked.alias("found"), F.lit(None).cast("bigint").alias("copies"))
    rest = placed.where(F.col("strong") | ~has_part)
    rest = rest.select(*names, "strong", F.col("strong").alias("found"), F.when(F.col("kind") == "row", F.col("copies")).alias("copies"))
    return rest.unionByName(met)


def spans(df: DataFrame, key: str = "doc_id", reach: int = REACH) -> DataFrame:
    """Per text (`key`, `mark`): `copies`, and the reported spans in order of start and kind (`kind`, `start`, `end`, `strong`)."""
    place = F.lit(len(ORDER))
    for kind, k in ORDER.items():
        place = F.when(F.col("kind") == kind, k).otherwise(place)
    one = F.when(F.col("found"), F.struct("start", place.alias("place"), "end", "kind", "strong"))
    return intervals(df, key, reach).groupBy("key", "mark").agg(
        F.sum("copies").alias("copies"), F.array_sort(F.collect_list(one)).alias("spans")
    )


def _same(value: str) -> Callable[[Column], Column]:
    return lambda x: x == value


def _written(spans_: Column) -> Column:
    return F.array_join(F.transform(spans_, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(df: DataFrame, key: str = "doc_id", reach: int = REACH) -> DataFrame:
    """Per row of `df`: numbers of strong findings, checksum of the strong spans, and all reported spans.

    Null texts have none; a null key is kept; repeated rows all come back; an empty table gives an empty result.
    """
    found = spans(df, key, reach)
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _same(kind))).cast("bigint").alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    base = F.filter("spans", lambda s: s["strong"])
    return found.select(
        F.col("key").alias(key), *counts, F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("again"),
    ).drop("again")


def _suspect(text: Column) -> Column:
    """Whether a text has candidates that may be reported: a strong one, or a weak secret and something to link it with."""

    def some(*kinds: str) -> Column:
        return reduce(Column.__or__, [text.rlike(pattern) for kind, pattern, *_ in KINDS if kind in kinds])

    strong = [kind for kind, *_, alone in KINDS if alone]
    return some(*strong) | (some("key", "random") & some("id", "endpoint"))


def masked(df: DataFrame, found: DataFrame) -> DataFrame:
    """`key`, `mark`, `masked`: the texts of `df` (`key`, `mark`, `text`) that have spans in `found`, with masks in place of these.

    Overlapping spans get one mask.  Texts are cut into pieces of SPAN characters and meet the parts of spans that lie in
    each, so the work is linear in the length of a text and the number of its spans.
    """
    text = ["key", "mark"]
    line = Window.partitionBy(*text).orderBy("start", "end", "kind")
    reached = F.coalesce(F.max("end").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    removed = found.withColumn("opens", (F.col("start") >= reached).cast("int"))
    removed = removed.withColumn("island", F.sum("opens").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    removed = removed.groupBy(*text, "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    removed = written(removed, "removed")
    base = F.col("piece") * SPAN
    cut = F.struct(
        F.greatest(F.col("start") - base, F.lit(0)).cast("int").alias("low"), F.least(F.col("end") - base, F.lit(SPAN)).cast("int").alias("high"),
        (F.col("start") >= base).alias("opens"),
    )
    cuts = removed.withColumn("piece", _stretches(F.col("start"), F.col("end") - 1))
    cuts = cuts.select(*text, F.col("piece").cast("bigint").alias("piece"), cut.alias("cut"), F.lit(None).cast("string").alias("chars"))
    named = removed.select(F.col("key").alias("of"), F.col("mark").alias("of_mark")).distinct()
    rows = df.join(named, F.col("key").eqNullSafe(F.col("of")) & (F.col("mark") == F.col("of_mark")), "left_semi")
    rows = rows.select(*text, F.posexplode(F.regexp_extract_all("text", F.lit(f"(?s).{{1,{SPAN}}}"), F.lit(0))).alias("piece", "chars"))
    rows = rows.select(*text, F.col("piece").cast("bigint").alias("piece"), F.lit(None).cast(cuts.schema["cut"].dataType).alias("cut"), "chars")
    pieces = rows.unionByName(cuts).groupBy(*text, "piece")
    pieces = pieces.agg(F.max("chars").alias("chars"), F.array_sort(F.collect_set("cut")).alias("cuts"))

    def kept(c: Column, number: Column) -> Column:
        last = F.coalesce(F.get(F.col("cuts"), number - 1)["high"], F.lit(0))
        return F.concat(F.substring(F.col("chars"), last + 1, c["low"] - last), F.when(c["opens"], MASK).otherwise(""))

    rest = F.substring(F.col("chars"), F.coalesce(F.array_max(F.transform("cuts", lambda c: c["high"])), F.lit(0)) + 1, F.lit(SPAN))
    chars = F.concat(F.array_join(F.transform("cuts", kept), ""), rest)
    whole = F.array_sort(F.collect_list(F.struct("piece", chars.alias("chars"))))
    return pieces.groupBy(*text).agg(F.array_join(F.transform(whole, lambda p: p["chars"]), "").alias("masked"))


def redacted(df: DataFrame, reach: int = REACH) -> DataFrame:
    """The documents with every reported span replaced by a mask; texts without any stay as they are.

    Only texts with candidates that may be reported are scanned in whole and shuffled; the others pass through.  Null
    texts stay null, a null key is kept, repeated rows all come back; an empty table gives an empty result.
    """
    rows = df.select(*DOCUMENT_COLUMNS)
    suspect = _suspect(filled())
    few = written(rows.where(suspect).withColumn("mark", F.xxhash64("text")), "suspects")
    found = intervals(few, "doc_id", reach).where("found").select("key", "mark", "kind", "start", "end")
    masks = masked(few.select(F.col("doc_id").alias("key"), "mark", "text"), found).withColumnRenamed("mark", "of_mark")
    few = few.join(masks, F.col("doc_id").eqNullSafe(F.col("key")) & (F.col("mark") == F.col("of_mark")), "left")
    n_chars = F.when(F.col("masked").isNull(), F.col("n_chars")).otherwise(F.length("masked")).cast("bigint")
    few = few.select("doc_id", F.coalesce("masked", "text").alias("text"), "lang", "source", n_chars.alias("n_chars"))
    return rows.where(~suspect).withColumn("n_chars", F.col("n_chars").cast("bigint")).unionByName(few)
