"""Secrets by their form and by the entropy of sliding windows, in SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazemill.llm.common import stored

# The forms that are always reported, by kind in the order of listing.
ASSIGN = (
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Runs that may be a secret: long enough for one window.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
BASE_KINDS = ("assign", "access", "hex")

#: Characters of a window, and the entropy in bits from which a window is suspicious, by
#: the class of characters that the candidate is made of (in order; the first that fits).
WINDOW = 20
CLASSES = {
    "entropy_hex": (r"^(?=.*[0-9])(?=.*[A-Fa-f])[0-9A-Fa-f]+$", 3.0),
    "entropy_alnum": (r"^(?=.*[0-9])(?=.*[A-Za-z])[0-9A-Za-z]+$", 3.7),
    "entropy_base64": (r"^(?=.*[0-9])(?=.*[A-Za-z])[0-9A-Za-z+/_=-]+$", 3.8),
    "entropy_letters": (r"^(?=.*[a-z])(?=.*[A-Z])[A-Za-z]+$", 4.0),
}
#: Candidates that are no secret however they look: UUIDs, paths of words.
ALLOWED = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"^/?[a-z]++(?:[/_-][a-z]++)++[0-9]{0,4}$",  # possessive: no stack frame per segment
)
#: Suspicious stretches that are no secret: sample keys.
ALLOWED_STRETCH = r"(?i)example|sample|placeholder|abcdefgh|01234567"
KINDS = (*BASE_KINDS, *CLASSES)


def _matches(kind: str, pattern: str) -> Column:
    """Array of ``kind, at, before, found``: a match's number, the characters between it
    and the match before, its text. Empty where the text has none."""
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    between = F.split("text", pattern, -1)
    made = F.transform(
        F.arrays_zip(found.alias("found"), F.slice(between, 1, F.size(found)).alias("between")),
        lambda m, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("at"),
            F.length(m["between"]).cast("long").alias("before"), m["found"].alias("found"),
        ),
    )
    none = F.expr("cast(array() as array<struct<kind:string,at:int,before:bigint,found:string>>)")
    return F.when(F.col("text").rlike(pattern), made).otherwise(none)


def _entropy_spans(candidates: DataFrame) -> DataFrame:
    """Suspicious stretches of candidates (``key, start, found``): ``key, kind, start, end``.

    Per position two counts tell how the window's counts change: how often the character
    that leaves was in the window, and how often the one that enters is. The running sum of
    the changes of n * log2(n) gives every window's entropy; nothing is counted anew.
    """
    kind, least = F.lit(None).cast("string"), F.lit(None).cast("double")
    for name, (form, bits) in reversed(CLASSES.items()):
        kind = F.when(F.col("found").rlike(form), name).otherwise(kind)
        least = F.when(F.col("found").rlike(form), bits).otherwise(least)
    allowed = F.lit(False)
    for form in ALLOWED:
        allowed = allowed | F.col("found").rlike(form)
    suspects = candidates.filter(~allowed).withColumns({"kind": kind, "least": least})
    suspects = suspects.filter("kind is not null")
    letters = suspects.select(
        "key", "start", "kind", "least", F.posexplode(F.split("found", "")).alias("at", "letter")
    ).filter("letter <> ''")
    same = Window.partitionBy("key", "start", "letter").orderBy("at")
    walk = Window.partitionBy("key", "start").orderBy("at")
    counted = letters.withColumns({
        "entering": F.count("*").over(same.rangeBetween(1 - WINDOW, -1)),
        "staying": F.count("*").over(same.rangeBetween(1, WINDOW - 1)),
    })

    def bits(n: Column) -> Column:
        return F.when(n > 1, n * F.log2(n)).otherwise(0.0)

    # A character's leaving is due WINDOW steps after it: it takes along what it brought
    # beyond those of its kind that stay.
    entered = bits(F.col("entering") + 1) - bits(F.col("entering"))
    left = F.lag(bits(F.col("staying") + 1) - bits(F.col("staying")), WINDOW, 0.0).over(walk)
    change = counted.select("key", "start", "kind", "least", "at", (entered - left).alias("change"))
    windows = change.withColumn("sum", F.sum("change").over(walk.rowsBetween(Window.unboundedPreceding, 0)))
    entropy = F.log2(F.lit(float(WINDOW))) - F.col("sum") / WINDOW
    hot = windows.filter(F.col("at") >= WINDOW - 1).filter(entropy >= F.col("least"))
    stretches = hot.groupBy("key", "start", "kind").agg(
        (F.min("at") - (WINDOW - 1)).alias("first"), F.max("at").alias("last")
    )
    # Only the stretch's own characters can excuse it: a word elsewhere in a path does not.
    stretches = stretches.join(suspects.select("key", "start", "found"), ["key", "start"])
    own = F.substring(F.col("found"), F.col("first") + 1, F.col("last") - F.col("first") + 1)
    return stretches.filter(~own.rlike(ALLOWED_STRETCH)).select(
        "key", "kind", (F.col("start") + F.col("first")).alias("start"),
        (F.col("start") + F.col("last") + 1).alias("end"),
    )


def find_secrets(docs: DataFrame) -> DataFrame:
    """Secrets of every whole text.

    ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``: the forms are always
    reported; entropy adds stretches of 20 characters or more that look random for their
    class and are not on the allow-list. Offsets are code points. A null text is an empty
    one. One row per input row, repeated or without ``doc_id``; an empty table gives no
    rows; other columns are not looked at. The text is read once; only matches are shuffled.
    """
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    matches = F.concat(
        _matches("assign", ASSIGN), _matches("access", ACCESS), _matches("hex", HEX),
        _matches("candidate", CANDIDATE),
    )
    # Rows with the same key are equal, and so are their secrets.
    read = stored(
        given.select(
            "doc_id",
            F.struct("doc_id", F.xxhash64("text").alias("a"), F.crc32(F.col("text").cast("binary")).alias("b")).alias("key"),
            matches.alias("matches"),
        ),
        "secrets",
    )
    once = read.filter(F.size("matches") > 0).dropDuplicates(["key"])
    rows = once.select("key", F.inline("matches"))
    places = Window.partitionBy("key", "kind").orderBy("at")
    length = F.length("found").cast("long")
    end = F.sum(F.col("before") + length).over(places.rowsBetween(Window.unboundedPreceding, 0))
    placed = rows.withColumn("end", end).withColumn("start", F.col("end") - length)
    value = F.length(F.regexp_extract("found", ASSIGN, 1))
    base = placed.filter(
        F.col("kind").isin("access", "hex") | ((F.col("kind") == "assign") & (value >= 8))
    ).select("key", "kind", "start", "end")
    extra = _entropy_spans(placed.filter("kind = 'candidate'").select("key", "start", "found"))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    named = F.struct(
        "start", order.alias("order"),
        F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string")).alias("span"),
    )
    spans = base.unionByName(extra).groupBy("key").agg(
        *(F.sum((F.col("kind") == k).cast("long")).alias(f"n_{k}") for k in BASE_KINDS),
        F.sort_array(F.collect_list(named)).alias("spans"),
    )
    joined = read.select("doc_id", "key").join(spans, "key", "left")
    listed = F.filter("spans", lambda s: s["order"] <= len(BASE_KINDS))
    text = F.coalesce(F.array_join(listed["span"], ","), F.lit(""))
    return joined.select(
        "doc_id",
        *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(text.cast("binary"), 256).alias("base_sha256"),
        F.coalesce(F.array_join(F.col("spans")["span"], ","), F.lit("")).alias("spans"),
    )
