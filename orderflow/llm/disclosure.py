"""Personal data and secrets, and terms of the corpus that give them away.

Patterns find the protected entities (e-mail addresses, IP addresses, card and phone
numbers, and values assigned to a token, password or key) with their positions. How
strongly a term reveals an entity is estimated from the whole corpus: with n documents,
of which n_e mention the entity, n_t hold the term and n_et hold both, it discloses

    log(n * n_et / (n_e * n_t)) / log(n / n_e)

of the entity's information. Terms from ``generalise`` on are replaced by [TERM], those
from ``remove`` on are removed, wherever they stand in a document that mentions the
entity. A term is a run of letters, marks and digits, joined by hyphens and apostrophes;
a script without spaces gives one term per run.

Entities that stand in the same documents tell the same, as do terms of equal n_t that
stand in the same documents with entities. Both are grouped by that first (the
documents' hashes added and combined by xor), so that groups meet and not all entities
and terms of a document.

A single document with an entity makes every rare word of it telling: of 1,000 documents
those in at most 7 are treated. ``doubt`` adds documents without the entity to n_t, which
treats fewer words on such thin evidence.

Defined cases: a null text is empty; rows of equal id and text count as one document and
get equal results; an entity in every document gives nothing away. An empty table gives
no rows. Native: columns only; each row's arrays cost n log n.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderflow.llm.text import bound, located, running, stored, whole

_LOCAL = "A-Za-z0-9._%+-"

#: The patterns start where no earlier start could match, or at the last match's
#: end, and never give back, so a scan is linear in the text.
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A name that says so, an assignment and a value, which is what counts.
SECRET = r"(?i:token|secret|password|passwd|key)[\"']?[\x20]?[:=][\x20]?[\"']?[A-Za-z0-9+/_-]{16,}"
SECRET_VALUE = "[A-Za-z0-9+/_-]+$"
KINDS = (*PATTERNS, "secret", "term")
TERM_KIND = KINDS.index("term")
#: A text without a match of these has no match of the pattern either.
HINTS = {"email": "@", "ip": "[0-9]\\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "\\+[0-9]"}

_BYTE = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_SIGN = r"[\p{L}\p{M}\p{N}]"
TOKEN = rf"{_SIGN}++(?:[-'’‐‑]{_SIGN}++)*+"

SPANS = "array<struct<start:int,kind:int,stop:int,removed:boolean>>"
MENTIONS = "array<struct<start:int,kind:int,stop:int,entity:string>>"
TERMS = "array<struct<start:int,stop:int,term:string,free:boolean>>"
ROW = ["__id", "__mark"]

#: Code points of the pieces that a text is cut into.
PIECE = 256


@dataclass(frozen=True)
class Disclosure:
    generalise: float = 0.7
    remove: float = 0.9
    doubt: float = 0.0


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$")
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(14, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def _entity(kind: str, value: Column) -> Column:
    plain = F.lower(value) if kind in ("email", "ip") else _digits(value)
    return F.concat(F.lit(f"{kind}:"), plain)


def _mention(kind: str, start: Column, stop: Column, entity: Column) -> Column:
    return F.struct(
        start.alias("start"),
        F.lit(KINDS.index(kind)).alias("kind"),
        stop.alias("stop"),
        entity.alias("entity"),
    )


def _of_pattern(text: Column, kind: str) -> Column:
    """Valid matches of one kind."""
    found = F.filter(located(text, PATTERNS[kind]), lambda x: _valid(kind, x["value"]))
    return F.when(
        text.rlike(HINTS[kind]),
        F.transform(
            found, lambda x: _mention(kind, x["start"], x["stop"], _entity(kind, x["value"]))
        ),
    ).otherwise(F.array().cast(MENTIONS))


def _secrets(text: Column) -> Column:
    def secret(x: Column) -> Column:
        return bound(
            F.regexp_extract(x["value"], SECRET_VALUE, 0),
            lambda v: _mention(
                "secret", x["stop"] - F.length(v), x["stop"], F.concat(F.lit("secret:"), v)
            ),
        )

    return F.when(text.rlike(SECRET), F.transform(located(text, SECRET), secret)).otherwise(
        F.array().cast(MENTIONS)
    )


def mentions(text: Column) -> Column:
    """All protected entities of a text, by start and kind."""
    return F.array_sort(F.concat(*(_of_pattern(text, kind) for kind in PATTERNS), _secrets(text)))


def _tokens(text: Column, found: Column) -> Column:
    """All terms of a text: array of (start, stop, term, free); those that overlap a
    mention are not free."""

    def event(x: Column, kind: int, term: Column) -> Column:
        return F.struct(
            x["start"].alias("start"),
            F.lit(kind).alias("kind"),
            x["stop"].alias("stop"),
            term.alias("term"),
        )

    def freed(events: Column) -> Column:
        def token(x: Column, i: Column, reached: Column) -> Column:
            later = F.get(events, i + 1)
            meets = (later["kind"] == 0) & (later["start"] < x["stop"])
            free = (F.get(reached, i) <= x["start"]) & ~F.coalesce(meets, F.lit(False))
            return F.when(
                x["kind"] == 1, F.struct(x["start"], x["stop"], x["term"], free.alias("free"))
            )

        stops = F.transform(events, lambda x: F.when(x["kind"] == 0, x["stop"]).otherwise(0))
        tokens = bound(
            running(stops, F.greatest),
            lambda reached: F.transform(events, lambda x, i: token(x, i, reached)),
        )
        return F.filter(tokens, lambda x: x.isNotNull())

    spoken = F.transform(located(text, TOKEN), lambda x: event(x, 1, F.lower(x["value"])))
    named = F.transform(found, lambda x: event(x, 0, F.lit("")))
    return bound(F.array_sort(F.concat(named, spoken)), freed)


def _row_key() -> dict[str, Column]:
    return {
        "__id": F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
        "__mark": F.xxhash64(whole("text")),
    }


def spoken(docs: DataFrame) -> tuple[DataFrame, int, bool]:
    """(term, n_t) over all documents, their number, and whether rows repeat."""
    keys = docs.select("doc_id", "text").withColumns(_row_key())
    # Equal rows count once, through the rows they stand for.
    repeats = keys.groupBy(*ROW).agg(F.count("*").alias("rows"))
    repeats = stored(repeats.groupBy((F.col("rows") > 1).alias("several")).agg(
        F.count("*").alias("n")
    ), "disclosure-rows")
    counts = {r.several: r.n for r in repeats.collect()}
    held = F.transform(
        F.regexp_extract_all(whole("text"), F.lit(TOKEN), F.lit(0)), lambda x: F.lower(x)
    )
    if counts.get(True):
        # Texts of equal rows are equal, so any one of them will do.
        keys = keys.groupBy(*ROW).agg(F.any_value("text").alias("text"))
    terms = (
        keys.select(F.explode(F.array_distinct(held)).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n_t"))
    )
    return terms, sum(counts.values()), bool(counts.get(True))


def _grouped(pairs: DataFrame, item: str, *own: str) -> tuple[DataFrame, DataFrame]:
    """(row, group) and (item, group) of (row, item) pairs, with the number of rows and
    the columns of an item's own: items of one group stand in the same rows."""
    row = F.xxhash64(*ROW)
    group = F.struct(
        F.sum(row.cast("decimal(20,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit(item), *ROW)).alias("parity"),
        F.count("*").alias("rows"),
        *own,
    )
    groups = stored(pairs.groupBy(item, *own).agg(group.alias("group")), f"disclosure-{item}")
    groups = groups.select(item, "group")
    rows = pairs.select(*ROW, item).join(groups, item).select(*ROW, "group").distinct()
    return stored(rows, f"disclosure-{item}-rows"), groups


def told_terms(docs: DataFrame, held: DataFrame, rule: Disclosure) -> DataFrame:
    """__id, __mark, start, stop and removed of the terms that give an entity away."""
    terms, n, repeated = spoken(docs)
    if repeated:
        held = held.dropDuplicates(ROW)
    named = held.select(*ROW, F.explode(F.array_distinct("__found.entity")).alias("entity"))
    named, entities = _grouped(named, "entity")
    named = named.where(F.col("group.rows") < n)
    widest = named.agg(F.max("group.rows")).head()[0] or 0

    def rarest(n_e: Column) -> Column:
        """No term of more documents tells enough, as n_et <= n_e."""
        return F.pow(F.lit(float(n)), 1 - rule.generalise) * F.pow(n_e, rule.generalise) * 1.000001

    terms = terms.where(F.col("n_t") <= rarest(F.lit(float(widest))))
    spots = held.select(*ROW, F.explode("__terms").alias("t")).select(*ROW, "t.*")
    spots = stored(spots, "disclosure-spots")
    said = spots.select(*ROW, "term").distinct().join(terms, "term")
    said, groups = _grouped(stored(said, "disclosure-said"), "term", "n_t")

    both = named.withColumnRenamed("group", "e").join(said.withColumnRenamed("group", "t"), ROW)
    both = both.where(F.col("t.n_t") <= rarest(F.col("e.rows")))
    n_e, n_t = F.col("e.rows"), F.col("t.n_t") + F.lit(rule.doubt)
    told = F.log2(F.lit(n) * F.col("n_et") / (n_e * n_t)) / F.log2(F.lit(n) / n_e)
    rated = (
        both.groupBy("e", "t")
        .agg(F.count("*").alias("n_et"))
        .withColumn("told", told)
        .where(F.col("told") >= rule.generalise)
        .select("e", "t", (F.col("told") >= rule.remove).alias("removed"))
    )
    treated = both.join(rated, ["e", "t"]).groupBy(*ROW, "t").agg(F.max("removed").alias("removed"))
    treated = treated.join(groups.withColumnRenamed("group", "t"), "t")
    return (
        spots.where("free")
        .join(treated.select(*ROW, "term", "removed"), [*ROW, "term"])
        .select(*ROW, "start", "stop", "removed")
    )


def rewritten(text: Column, spans: Column) -> Column:
    """The text with [KIND] for each span, and nothing for removed ones; of overlapping
    spans the first one's name stands for all."""
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))

    def cut(pieces: Column, a: Column, b: Column) -> Column:
        """Code points a to b - 1."""
        first, last = F.shiftright(a, 8), F.shiftright(b - 1, 8)
        at, end = a - first * PIECE, b - last * PIECE
        inner = F.array_join(F.slice(pieces, first + 2, last - first - 1), "")
        across = F.concat(
            F.substring(F.get(pieces, first), at + 1, F.lit(PIECE)), inner, F.left(F.get(pieces, last), end)
        )
        one = F.substring(F.get(pieces, first), at + 1, b - a)
        return F.when(b <= a, "").when(first == last, one).otherwise(across)

    def rebuilt(pieces: Column) -> Column:
        def parts(reached: Column) -> Column:
            def part(x: Column, i: Column) -> Column:
                done = F.when(i == 0, F.lit(0)).otherwise(F.get(reached, i - 1))
                name = F.when((x["start"] < done) | x["removed"], F.lit("")).otherwise(
                    F.get(names, x["kind"])
                )
                return F.concat(cut(pieces, done, x["start"]), name)

            tail = cut(pieces, F.element_at(reached, -1), F.length(text))
            return F.concat(F.array_join(F.transform(spans, part), ""), tail)

        return bound(running(F.transform(spans, lambda x: x["stop"]), F.greatest), parts)

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return F.when(F.size(spans) == 0, text).otherwise(bound(pieces, rebuilt))


def sanitised(docs: DataFrame, rule: Disclosure = Disclosure()) -> DataFrame:
    """The documents with ``base`` and ``spans``, arrays of (start, kind, stop, removed)
    ordered by start and kind, and ``sanitised``, the text with all spans treated. base
    holds what the patterns of the four kinds found, spans also secrets and terms.

    Documents without an entity stay in their task; the others are written and meet
    their terms.
    """
    extra = ["base", "spans", "sanitised"]
    kept = [c for c in docs.columns if c not in extra]
    marked = docs.select(*kept, mentions(whole("text")).alias("__found"))
    none = F.array().cast(SPANS)
    clean = marked.where(F.size("__found") == 0).select(
        *kept, none.alias("base"), none.alias("spans"), F.col("text").alias("sanitised")
    )
    held = marked.where(F.size("__found") > 0).withColumns(
        {**_row_key(), "__terms": _tokens(F.col("text"), F.col("__found")).cast(TERMS)}
    )
    held = stored(held, "disclosure-held")
    term = F.struct(
        F.col("start").cast("int").alias("start"),
        F.lit(TERM_KIND).alias("kind"),
        F.col("stop").cast("int").alias("stop"),
        "removed",
    )
    listed = told_terms(docs, held, rule).groupBy(*ROW).agg(F.collect_set(term).alias("__told"))
    found = F.transform(
        "__found",
        lambda m: F.struct(m["start"], m["kind"], m["stop"], F.lit(False).alias("removed")),
    )
    base = F.filter(found, lambda x: x["kind"] < len(PATTERNS))
    spans = F.array_sort(F.concat(found, F.coalesce("__told", none)))
    treated = held.join(listed, ROW, "left").withColumns({"base": base, "spans": spans})
    treated = treated.withColumn("sanitised", rewritten(F.col("text"), F.col("spans")))
    return clean.union(treated.select(*kept, *extra))


def written(places: Column) -> Column:
    """kind:start:stop of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            places,
            lambda x: F.concat_ws(
                ":", F.get(names, x["kind"]), x["start"].cast("string"), x["stop"].cast("string")
            ),
        ),
        ",",
    )


def of_kind(places: Column, kind: str) -> Column:
    return F.size(F.filter(places, lambda x: x["kind"] == KINDS.index(kind))).cast("long")
