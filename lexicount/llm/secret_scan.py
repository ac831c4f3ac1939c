"""Secrets by corpus-wide ownership frequency (operator 6), DataFrame
functions only.

Candidates are regular-expression matches. Their places come from the regular
expression itself: the text split at the matches gives the gaps between them,
and running sums of gaps and matches (a window over one text's matches) the
offsets in code points. Every candidate's value is hashed, and the hashes are
counted over the corpus by distinct repositories and owners: a value that
``EXAMPLE_OWNERS`` or more owners hold is a widely copied example, any other
one that looks random is live. Live candidates of the kinds in ``ADDED`` join
the base spans; base spans are always reported.

A hot value costs one row per (owner, repository) and task before the shuffle.
Null and empty texts have no span; a null owner or repository counts as one of
its own; repeated rows each get their result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexicount.llm._spark import packed_row, text_key, unpacked, written

EXAMPLE_OWNERS = 3
#: A live value has this many different characters, and a digit.
LEAST_DISTINCT = 8

# (kind, pattern, group of the value, least length of that group).
# The first three are fixed by the base; a group's least length of 1 means
# that the pattern itself says what is long enough.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
ADDED = (
    ("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----[A-Za-z0-9+/=\s]{16,}", 0, 1),
    ("prefixed", r"(?<![A-Za-z0-9_])(?:gh[pousr]_|glpat-|xox[abprs]-|sk-|sk_live_|AIza)[A-Za-z0-9_-]{16,}", 0, 1),
    ("login", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,64}:([^\s:/@]{6,64})@", 1, 6),
    ("random", r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}", 0, 20),
)
KINDS = (*BASE, *ADDED)
#: "random" must have letters of both cases and a digit.
_RANDOM = r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"


def _found(text: Column, no: int) -> Column:
    """Matches of kind ``no``: their order, the gap before each, their length
    and value. (Java's split and extract walk through the same matches.)"""
    _, pattern, group, _ = KINDS[no]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    zipped = F.arrays_zip(F.slice(gaps, 1, F.size(whole)).alias("gap"), whole.alias("whole"), value.alias("value"))
    rows = F.transform(zipped, lambda x, i: F.struct(
        F.lit(no).alias("no"), i.alias("nth"), F.length(x["gap"]).alias("gap"), F.length(x["whole"]).alias("size"),
        x["value"].alias("value"),
    ))
    return F.when(text.rlike(pattern), rows).otherwise(F.array().cast("array<struct<no:int,nth:int,gap:int,size:int,value:string>>"))


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repo: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """``(rows, spans)``: every row of ``docs`` under a number, and its
    candidates ``(row, no, start, end, value, owner, repo)``."""
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = written(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
            text_key(body).alias("tkey"), F.col(f"`{owner}`").cast("string").alias("owner"),
            F.col(f"`{repo}`").cast("string").alias("repo"),
            F.concat(*[_found(body, n) for n in range(len(KINDS))]).alias("found"),
        ),
        "secret-candidates",
    )
    each = rows.filter(F.size("found") > 0).select("row", "owner", "repo", F.explode("found").alias("f")).select("row", "owner", "repo", "f.*")
    order = Window.partitionBy("row", "no").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(order).cast("int"))
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS]), F.col("no") + 1)
    random = len(KINDS) - 1
    good = (F.length("value") >= least) & ((F.col("no") != random) | F.col("value").rlike(_RANDOM))
    spans = placed.filter(good).select(
        "row", "no", (F.col("end") - F.col("size")).alias("start"), "end", "value", "owner", "repo"
    )
    return rows.drop("found"), written(spans, "secret-spans")


def ownership(spans: DataFrame) -> DataFrame:
    """``(value_hash, n_repos, n_owners)`` over the corpus."""
    one = spans.select(F.sha2("value", 256).alias("value_hash"), "owner", "repo")
    return (
        one.groupBy("value_hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("value_hash", "owner").agg(F.count(F.lit(1)).alias("n_repos"))
        .groupBy("value_hash").agg(F.sum("n_repos").cast("long").alias("n_repos"), F.count(F.lit(1)).alias("n_owners"))
    )


def _covered() -> Column:
    """Whether a span gives way: an added kind does if it is not live, or meets
    a base span or a live one of a kind listed before its own. Of a text's spans
    by their start one sweep keeps the last end so far, another from the back
    the next start, kind by kind; no span is held against all others."""
    ahead = Window.partitionBy("row").orderBy("start", "no").rowsBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("no")).rowsBetween(Window.unboundedPreceding, 0)
    met = F.lit(False)
    for no in range(len(KINDS) - 1):
        stays = (F.col("no") == no) & (F.col("live") | F.lit(no < len(BASE)))
        last = F.max(F.when(stays, F.col("end"))).over(ahead)
        nearest = F.min(F.when(stays, F.col("start"))).over(behind)
        overlap = F.coalesce(last > F.col("start"), F.lit(False)) | F.coalesce(nearest < F.col("end"), F.lit(False))
        met = met | ((F.col("no") > no) & overlap)
    return (F.col("no") >= len(BASE)) & (~F.col("live") | met)


def scanned(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repo: str = "doc_id",
    example_owners: int = EXAMPLE_OWNERS,
) -> DataFrame:
    """Per row of ``docs``: ``(doc_id, tkey, spans)``; a span has ``start, no,
    end, kind, live, n_repos, n_owners``, sorted by start, then kind as listed."""
    rows, spans = candidates(docs, doc_id, text, owner, repo)
    owned = ownership(spans).select(F.col("value_hash").alias("o_hash"), "n_repos", "n_owners")
    distinct = F.size(F.array_distinct(F.split("value", "")))
    live = (F.col("n_owners") < F.lit(example_owners)) & (distinct >= LEAST_DISTINCT) & F.col("value").rlike("[0-9]")
    kind = F.element_at(F.array(*[F.lit(k[0]) for k in KINDS]), F.col("no") + 1)
    judged = spans.withColumn("h", F.sha2("value", 256)).join(owned, F.col("h") == F.col("o_hash")).select(
        "row", F.struct("start", "no", "end", kind.alias("kind"), live.alias("live"), "n_repos", "n_owners").alias("s")
    )
    judged = judged.select("row", "s", "s.start", "s.no", "s.end", "s.live")
    per_row = judged.withColumn("gone", _covered()).filter("NOT gone").groupBy(F.col("row").alias("s_row")).agg(F.array_sort(F.collect_list("s")).alias("spans"))
    none = F.array().cast("array<struct<start:int,no:int,end:int,kind:string,live:boolean,n_repos:bigint,n_owners:bigint>>")
    return rows.join(per_row, F.col("row") == F.col("s_row"), "left").select(
        "doc_id", "tkey", F.coalesce("spans", none).alias("spans")
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


_BLOCK = 512


def _piece(a: Column, b: Column) -> Column:
    """Code points ``a`` to ``b`` of the text that ``blocks`` holds in order,
    ``_BLOCK`` of them in each."""
    first, last = F.floor(a / _BLOCK), F.floor((b - 1) / _BLOCK)
    block = lambda k: F.get("blocks", k.cast("int"))
    inside = F.substring(block(first), a % _BLOCK + 1, b - a)
    between = F.slice("blocks", (first + 2).cast("int"), (last - first - 1).cast("int"))
    over = F.concat(
        F.substring(block(first), a % _BLOCK + 1, F.lit(_BLOCK)), F.array_join(between, ""),
        F.substring(block(last), F.lit(1), (b - 1) % _BLOCK + 1),
    )
    return F.when(a >= b, F.lit("")).when(first == last, inside).otherwise(over)


def redacted(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", owner: str = "source", repo: str = "doc_id", mark: str = "[secret]", **options) -> DataFrame:
    """``docs`` with every live span replaced by ``mark``, same columns; an
    ``n_chars`` column follows the text. Widely copied examples stay."""
    found = scanned(docs, doc_id, text, owner, repo, **options)
    hits = found.select(
        F.col("doc_id").alias("h_id"), F.col("tkey").alias("h_key"), F.filter("spans", lambda x: x["live"]).alias("live")
    ).filter(F.size("live") > 0).dropDuplicates(["h_id", "h_key"])
    # What lies between the spans, from the last end so far to the next start; a
    # span that begins before that end only moves it.
    each = hits.select("h_id", "h_key", F.explode("live").alias("s")).select("h_id", "h_key", "s.start", "s.end")
    so_far = Window.partitionBy("h_id", "h_key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("at", F.coalesce(F.max("end").over(so_far), F.lit(0)))
    gap = F.when(F.col("start") >= F.col("at"), F.struct(F.col("at").alias("a"), F.col("start").alias("b")))
    hits = each.groupBy("h_id", "h_key").agg(F.array_sort(F.collect_list(gap)).alias("cut"), F.max("end").alias("tail"))
    body = F.col(f"`{text}`")
    rows = docs.select(
        packed_row(docs, text), body.cast("string").alias("text"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        text_key(body).alias("tkey"),
    )
    joined = rows.join(hits, (F.col("tkey") == F.col("h_key")) & F.col("doc_id").eqNullSafe(F.col("h_id")), "left")
    pieces = F.concat(F.transform("cut", lambda g: _piece(g["a"], g["b"])), F.array(_piece(F.col("tail"), F.length("text"))))
    done = F.array_join(pieces, mark)
    whole = F.col("cut").isNull()
    # Cut once, so that a piece is found without walking from the start.
    joined = joined.withColumn("blocks", F.when(~whole, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))))
    wide = joined.withColumn("new", F.when(whole, F.col("text")).otherwise(done))
    new = {text: F.col("new")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(whole, F.col("row.n_chars")).otherwise(F.length("new"))
    return unpacked(wide, docs, new)
