"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

1. Seeds. E-mail addresses, IP addresses, card and phone numbers are found by shape and check.
2. Patterns. The word before an identifier-like token and the token's shape (letters, digits
   and signs run-length folded) form its lexical pattern. Seeds and all other identifier-like
   tokens of the corpus make a graph of patterns and instances.
3. Scores. For `ROUNDS` rounds a pattern's confidence is the mean score of its instances,
   shrunk towards nothing for patterns with few distinct instances, and an instance's score is
   its best pattern's confidence; seeds keep score 1. All steps are joins and aggregations.
4. Discovery. Instances that no seed rule found, in patterns of confidence `CONFIDENT` or more,
   become spans of kind `context`, where they do not overlap a base span.

A span's place is found natively: matches are replaced by themselves between two marks, the
text is split at the marks, and places are running sums of the pieces' lengths. An array grows by
being copied, so the pieces are folded in chunks and the chunks' results once more: the time is
linear in the text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regflow.llm.common import checkpointed, ids_and_texts, stored

ROUNDS = 3
CONFIDENT = 0.8
#: Confidence is n / (n + SHRINK) of the mean score, n the pattern's distinct instances.
SHRINK = 1.0
#: Pieces of a text that are folded together, and characters of a text in which tokens and base
#: spans are compared. Both bound what meets in one step, and change no result.
CHUNK, STRETCH = 256, 64

# The shapes of the base kinds. Possessive runs, and starts only where a run
# starts or the last match ended, find the same matches in time linear in the text.
_LOCAL = r"[A-Za-z0-9._%+-]"
_PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = (*_PATTERNS, "context")
# A whole word with a digit or an at sign.
_TOKEN = r"(?<!\S)[^\s0-9@]*+[0-9@]\S*+"
# Marks from the private use area; where a text has them, they count as a question mark.
_OPEN, _CLOSE = "\ue000", "\ue001"
_SPAN = "array<struct<start:int,end:int,text:string>>"


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _pieces(text: Column, pattern: str) -> Column:
    """The text up to the first match, then for each match: it, the closing mark, and what follows."""
    return F.split(F.regexp_replace(text, f"({pattern})", f"{_OPEN}$1{_CLOSE}"), _OPEN)


def _placed(parts: Column) -> Column:
    """The matches in `_pieces` as (start, end, text), places in code points."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))

    def step(state: Column, part: Column) -> Column:
        size = F.instr(part, _CLOSE) - 1
        match = F.substring(part, F.lit(1), size)
        at = state["at"]
        one = F.struct(
            at.cast("int").alias("start"), (at + size).cast("int").alias("end"), match.alias("text")
        )
        return F.struct(
            (at + F.char_length(part) - F.when(size >= 0, 1).otherwise(0)).cast("int").alias("at"),
            F.when(size >= 0, F.concat(state["found"], F.array(one))).otherwise(state["found"]).alias("found"),
        )

    starts = F.sequence(F.lit(1), F.size(parts), F.lit(CHUNK))
    chunks = F.transform(starts, lambda first: F.aggregate(F.slice(parts, first, F.lit(CHUNK)), empty, step))
    none = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("all"))

    def join(state: Column, chunk: Column) -> Column:
        at = state["at"]

        def moved(span: Column) -> Column:
            return F.struct(
                (span["start"] + at).cast("int").alias("start"),
                (span["end"] + at).cast("int").alias("end"),
                span["text"].alias("text"),
            )

        return F.struct(
            (at + chunk["at"]).cast("int").alias("at"),
            F.concat(state["all"], F.array(F.transform(chunk["found"], moved))).alias("all"),
        )

    return F.flatten(F.aggregate(chunks, none, join, lambda state: state["all"]))


def spans(text: Column, pattern: str, needs: Column) -> Column:
    """All matches of `pattern` as (start, end, text), places in code points. `text` holds no
    marks; where `needs` is false there are none."""
    found = _let(_pieces(text, pattern), _placed)
    return F.when(needs, found).otherwise(F.array().cast(_SPAN))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.sequence(F.lit(1), F.char_length(digits))

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(digits, place, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        second = (F.char_length(digits) - place) % 2 == 1
        return total + F.when(second, doubled).otherwise(digit)

    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _low_part(part: Column) -> Column:
    """A run of digits is at most 255, leading zeros aside."""
    short = F.regexp_replace(part, "^0+(?=[0-9])", "")
    return (F.char_length(short) <= 3) & (F.substring(short, 1, 3).cast("int") <= 255)


def _good(kind: str, text: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(text, r"\."), _low_part)
    if kind == "card":
        digits = _digits(text)
        size = F.char_length(digits)
        return F.when(size.between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.char_length(_digits(text)).between(9, 15)
    return F.lit(True)


def base_spans(docs: DataFrame) -> DataFrame:
    """Adds `base`: spans (start, end, rank, kind) of the base kinds, to rows (id, text)."""
    clean = F.translate("text", _OPEN + _CLOSE, "??")
    kept = docs.withColumn("plain", clean).withColumn("digit", F.col("plain").rlike("[0-9]"))
    needs = {"email": F.instr("plain", "@") > 0, "phone": F.col("digit") & (F.instr("plain", "+") > 0)}
    found = []
    for rank, (kind, pattern) in enumerate(_PATTERNS.items()):
        every = spans(F.col("plain"), pattern, needs.get(kind, F.col("digit")))
        good = F.filter(every, _good_span(kind))
        found.append(F.transform(good, _labelled(rank, kind)))
    return kept.withColumn("base", F.array_sort(F.concat(*found)))


def _good_span(kind: str):
    def good(span: Column) -> Column:
        return _good(kind, span["text"])

    return good


def _labelled(rank: int, kind: str):
    def label(span: Column) -> Column:
        return F.struct(
            span["start"].alias("start"), F.lit(rank).alias("rank"), span["end"].alias("end"), F.lit(kind).alias("kind")
        )

    return label


def _candidates() -> Column:
    """Identifier-like tokens of `plain`, each with a hash of the whole word ahead of it."""

    def cue(part: Column) -> Column:
        plain = F.regexp_replace(F.translate(part, _CLOSE, ""), r"\s+", " ")
        return F.xxhash64(F.lower(F.element_at(F.split(F.trim(plain), " "), -1)))

    def tokens(parts: Column) -> Column:
        # What precedes a match is the piece before its own.
        ahead = F.transform(F.slice(parts, F.lit(1), F.size(parts) - 1), cue)
        return F.zip_with(
            _placed(parts),
            ahead,
            lambda token, word: F.struct(
                token["start"].alias("start"), token["text"].alias("raw"), word.alias("cue")
            ),
        )

    found = _let(_pieces(F.col("plain"), _TOKEN), tokens)
    none = F.array().cast("array<struct<start:int,raw:string,cue:bigint>>")
    return F.when(F.col("digit") | (F.instr("plain", "@") > 0), found).otherwise(none)


def _tokens(found: DataFrame) -> DataFrame:
    """One row per identifier-like token: row, place, instance, pattern, seed."""
    rows = found.select("row", F.explode("tokens").alias("token")).select(
        "row", "token.start", "token.raw", "token.cue"
    )
    # Signs around a token are no part of it.
    lead = F.char_length("raw") - F.char_length(F.regexp_replace("raw", r"^[^\p{L}\p{N}+@]++", ""))
    body = _without_last_signs(F.regexp_replace("raw", r"^[^\p{L}\p{N}+@]++", ""))
    shape = F.regexp_replace(
        F.regexp_replace(F.regexp_replace(F.lower("body"), "[0-9]+", "9"), r"\p{L}+", "a"), r"9(?:a?9)++", "9"
    )
    rows = rows.withColumn("body", body).withColumn("start", F.col("start") + lead)
    rows = rows.withColumn("end", F.col("start") + F.char_length("body"))
    # An identifier has two digits at least, or an at sign, and four characters.
    able = F.col("body").rlike("@|[0-9][^0-9]*+[0-9]") & (F.char_length("body") >= 4)
    kept = rows.filter(able).select(
        "row",
        "start",
        "end",
        F.xxhash64(F.lower("body")).alias("instance"),
        F.xxhash64("cue", shape).alias("pattern"),
    )
    return _with_seeds(checkpointed(kept.distinct()), found)


def _without_last_signs(text: Column) -> Column:
    """The text up to its last letter or digit."""
    return F.reverse(F.regexp_replace(F.reverse(text), r"^[^\p{L}\p{N}]++", ""))


def _with_seeds(tokens: DataFrame, found: DataFrame) -> DataFrame:
    """Tokens with `seed`: whether a base span overlaps them. Both meet by stretches of the text
    that they touch, so that a long text is compared piece by piece."""

    def stretches(start: str, end: str) -> Column:
        return F.explode(F.sequence(F.expr(f"{start} div {STRETCH}"), F.expr(f"({end} - 1) div {STRETCH}")))

    base = found.select("row", F.explode("base").alias("span")).select(
        "row", F.col("span.start").alias("from"), F.col("span.end").alias("to")
    )
    base = base.filter("to > from").distinct().withColumn("stretch", stretches("from", "to"))
    touched = (
        tokens.select("row", "start", "end", stretches("start", "end").alias("stretch"))
        .join(base, ["row", "stretch"])
        .filter("from < end and to > start")
        .select("row", "start")
        .distinct()
        .withColumn("touched", F.lit(True))
    )
    return tokens.join(touched, ["row", "start"], "left").select(
        "row", "start", "end", "instance", "pattern", F.coalesce("touched", F.lit(False)).alias("seed")
    )


def confident_patterns(tokens: DataFrame, rounds: int, confident: float) -> DataFrame:
    """Patterns (pattern) whose confidence is at least `confident` after `rounds` rounds."""
    edges = checkpointed(
        tokens.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    )
    seeds = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("given"))
    scores = checkpointed(seeds.withColumn("score", F.col("given")))
    patterns = None
    for _ in range(rounds):
        patterns = checkpointed(
            edges.join(scores, "instance")
            .groupBy("pattern")
            .agg(
                (F.sum("score") / (F.count("*") + SHRINK)).alias("confidence"),
                F.sum(F.col("seed").cast("int")).alias("seeds"),
            )
        )
        scores = checkpointed(
            edges.join(patterns, "pattern")
            .groupBy("instance")
            .agg(F.max("confidence").alias("best"), F.max("seed").cast("double").alias("given"))
            .select("instance", "given", F.greatest("given", "best").alias("score"))
        )
    # At least one of its own instances must be a seed.
    return patterns.filter((F.col("confidence") >= confident) & (F.col("seeds") > 0)).select("pattern")


def find_personal_data(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rounds: int = ROUNDS,
    confident: float = CONFIDENT,
) -> DataFrame:
    """One row per document: id, base and all spans (start, rank, end, kind), by start and kind.

    A null or empty text has no spans; a null id stays null; repeated rows each give a row;
    other columns are not read. Texts are read whole, in linear time. An empty table gives an
    empty result.
    """
    found = base_spans(ids_and_texts(docs, id_col, text_col))
    # Texts are read once. Rows are told apart by a digest of id and text: equal rows have
    # equal spans.
    row = F.md5(F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("-")), "plain"))
    keyed = stored(found.select("id", row.alias("row"), "base", _candidates().alias("tokens")), "spans")
    tokens = checkpointed(_tokens(keyed))
    chosen = confident_patterns(tokens, rounds, confident)
    new = (
        tokens.filter(~F.col("seed"))
        .join(chosen, "pattern", "left_semi")
        .groupBy("row")
        .agg(
            F.array_sort(
                F.collect_set(
                    F.struct(
                        F.col("start").cast("int").alias("start"),
                        F.lit(len(_PATTERNS)).alias("rank"),
                        F.col("end").cast("int").alias("end"),
                        F.lit("context").alias("kind"),
                    )
                )
            ).alias("more")
        )
    )
    slim = keyed.select("id", "row", "base")
    every = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return slim.join(new, "row", "left").select("id", "base", every.alias("spans"))
