"""Secret scans with corpus-wide ownership of what is found.

Candidates of all kinds are cut out of each text with their places. Their hashes
are counted over the corpus by distinct document texts (repositories) and
distinct sources (owners). A value that many owners show is a copied example; a
value of one owner, with the disorder of a real key, looks live.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded, checkpointed

#: Base kinds in their order: pattern, group of the value, fewest characters of the value.
BASE = {
    "assign": (r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 12),
    "access": (r"AKIA[A-Z0-9]{14,}", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
}
#: Kinds of the method: prefixed service keys, web tokens and private key headers.
EXTRA = {
    "service": (r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|(?:sk|pk|rk)_(?:live|test)_[A-Za-z0-9]{10,}|AIza[A-Za-z0-9_-]{30,})", 0, 14),
    "jwt": (r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+", 0, 27),
    "pem": (r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 27),
}
KINDS = list(BASE) + list(EXTRA)
#: From so many owners, and so many different texts, a value counts as a copied example.
EXAMPLE_OWNERS, EXAMPLE_REPOSITORIES = 3, 3
#: Fewest different characters of a value that looks live.
LEAST_DISTINCT = 6


_MATCH = "array<struct<kind:int,nth:int,gap:int,size:int,value:string>>"


def _matches(text: Column, kind: str) -> Column:
    """Matches of a kind from the left: kind number, place among them, characters since the last one, own characters, value.

    The gaps between matches come from split, the matches from extract; their
    lengths add up to the places.
    """
    pattern, group, _ = (BASE | EXTRA)[kind]
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    each = F.arrays_zip(found.alias("m"), F.slice(gaps, 1, F.size(found)).alias("g"), values.alias("v"))
    number = F.lit(KINDS.index(kind))
    rows = F.transform(each, lambda x, i: F.struct(number.alias("kind"), i.alias("nth"), x["g"].alias("gap"), F.length(x["m"]).alias("size"), x["v"].alias("value")))
    return F.when(text.rlike(pattern), rows).otherwise(F.array()).cast(_MATCH)


def _placed(matches: DataFrame) -> DataFrame:
    """Matches (row, m) with start and end in code points; a running sum over the matches of one text. Too short values go."""
    before = Window.partitionBy("row", "m.kind").orderBy("m.nth")
    ends = matches.withColumn("end", F.sum(F.col("m.gap") + F.col("m.size")).over(before).cast("int"))
    fewest = F.element_at(F.array(*[F.lit(n) for _, _, n in (BASE | EXTRA).values()]), F.col("m.kind") + 1)
    return ends.filter(F.length("m.value") >= fewest).withColumn("start", F.col("end") - F.col("m.size"))


def looks_live(value: Column) -> Column:
    """Enough different characters, letters with digits (or a long value), and no word that examples carry."""
    different = F.size(F.array_distinct(F.split(value, ""))) >= LEAST_DISTINCT
    blend = (value.rlike("[0-9]") & value.rlike("[A-Za-z]")) | (F.length(value) >= 20)
    return different & blend & ~value.rlike("(?i)example|sample|placeholder|changeme|dummy|xxxx|0{8}|12345678")


def name(span: Column) -> Column:
    return F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), span["kind"] + 1), span["start"].cast("string"), span["end"].cast("string"))


def scan(docs: DataFrame, *, keep: tuple[str, ...] = ("doc_id",), owner: str = "source") -> DataFrame:
    """Candidates of each row of docs (doc_id, text and the owner column) with verdicts from the whole corpus.

    Returns the columns of `keep` and spans, an array of (start, kind, end, value,
    owners, repositories, verdict) in this order; places are code points and ends
    exclusive. The verdict is `example` for values of EXAMPLE_OWNERS owners and
    EXAMPLE_REPOSITORIES different texts, `live` for others that look like keys,
    else `weak`. Equal texts count as one repository; a null owner is one owner. A
    null or empty text has no spans; repeated rows have equal ones; an empty table
    gives an empty result; columns may have any name. A value that a third of all
    rows hold is counted after its distinct owners and texts, and its verdict is
    joined by plain shuffles on both sides, whose partitions adaptive execution
    splits; a task gathers the candidates of single texts only.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = reduce(F.concat, [_matches(text, k) for k in KINDS])
    who = F.xxhash64(F.coalesce(F.col(owner).cast("string"), F.lit("\u0000"))) if owner in docs.columns else F.lit(0).cast("long")
    rows = checkpointed(docs.select(F.struct(*keep).alias("kept"), who.alias("owner"), F.xxhash64("text").alias("repository"), found.alias("found"), F.monotonically_increasing_id().alias("row")))
    flat = _placed(rows.filter(F.size("found") > 0).select("row", "owner", "repository", F.explode("found").alias("m")))
    flat = checkpointed(flat.select("row", "owner", "repository", "start", F.col("m.kind").alias("kind"), "end", F.col("m.value").alias("value"), F.sha2("m.value", 256).alias("digest")))
    once = flat.select("digest", "owner", "repository").distinct()
    owners = once.groupBy("digest", "owner").agg(F.lit(1)).groupBy("digest").agg(F.count("*").alias("owners"))
    repositories = once.groupBy("digest", "repository").agg(F.lit(1)).groupBy("digest").agg(F.count("*").alias("repositories"))
    seen = flat.join(checkpointed(owners.join(repositories, "digest")), "digest")
    example = (F.col("owners") >= EXAMPLE_OWNERS) & (F.col("repositories") >= EXAMPLE_REPOSITORIES)
    verdict = F.when(example, "example").when(looks_live(F.col("value")) | (F.col("kind") == KINDS.index("pem")), "live").otherwise("weak")
    span = F.struct("start", "kind", "end", "value", "owners", "repositories", verdict.alias("verdict"))
    judged = seen.groupBy("row").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    empty = F.array().cast(judged.schema["spans"].dataType)
    return rows.join(judged, "row", "left").select("kept.*", F.coalesce("spans", empty).alias("spans"))


def digest_columns(found: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans, and all spans as text: base ones and, of the others, live ones."""
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))
    shown = F.filter("spans", lambda s: (s["kind"] < len(BASE)) | (s["verdict"] == "live"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(k))).cast("long")
    verdicts = lambda v: F.size(F.filter(shown, lambda s: s["verdict"] == v)).cast("long")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE], F.sha2(F.array_join(F.transform(base, name), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(shown, name), ",").alias("spans"), verdicts("live").alias("n_live"), verdicts("example").alias("n_example"),
    )


def redact(docs: DataFrame, *, mark: str = "[SECRET]", owner: str = "source") -> DataFrame:
    """docs with every span that looks live replaced by mark; other columns and rows stay as they are.

    Overlapping spans are replaced as one. Null texts stay null. Only the places of
    the spans are joined to the texts, by two checksums and the length of a text;
    a text is taken apart and put together once, however many spans it has.
    """
    key = F.struct(F.xxhash64("text").alias("x"), F.crc32(F.col("text").cast("binary")).alias("c"), F.length("text").alias("n"))
    keyed = docs.select(F.struct(*docs.columns).alias("row"), F.col("text"), key.alias("key"), *([F.col(owner).alias("owner")] if owner in docs.columns else []))
    found = scan(keyed, keep=("key",), owner="owner")
    live = found.filter(F.exists("spans", lambda s: s["verdict"] == "live")).groupBy("key").agg(F.first("spans").alias("spans")).select("key", F.posexplode("spans").alias("nth", "s")).filter("s.verdict = 'live'")
    behind = F.coalesce(F.max("s.end").over(Window.partitionBy("key").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cuts = live.withColumn("behind", behind).groupBy("key").agg(
        F.sort_array(F.collect_list(F.when(F.col("s.start") >= F.col("behind"), F.struct(F.col("s.start").alias("start"), "behind")))).alias("cuts"), F.max("s.end").alias("last")
    )
    places = checkpointed(cuts.withColumnRenamed("key", "at"))
    size = places.agg(F.count("*"), F.sum(F.size("cuts"))).first()
    joined = keyed.join(bounded(places, size[0] + (size[1] or 0), 96), F.col("key") == F.col("at"), "left")

    def hidden(letters: Column) -> Column:
        parts = F.transform("cuts", lambda c: F.concat(F.slice(letters, c["behind"] + 1, c["start"] - c["behind"]), F.array(F.lit(mark))))
        rest = F.slice(letters, F.col("last") + 1, F.size(letters))
        return F.array_join(F.concat(F.flatten(parts), rest), "")

    clean = F.transform(F.array(F.split("text", "")), hidden)[0]  # bound once, not for each cut
    text = F.when(F.col("at").isNotNull(), clean).otherwise(F.col("text"))
    return joined.select(*[text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns])
