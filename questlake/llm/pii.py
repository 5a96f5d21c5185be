"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Fixed forms (e-mail and IP addresses, card and phone numbers) are the seeds. The words around the
seeds are patterns; the shapes of all tokens that look like identifiers are instances. A pattern is
trusted as far as what stands in it is a seed or has a trusted shape, a shape as far as the
patterns it stands in are trusted; both are scored on the graph of patterns and shapes, a few
rounds in turn. What stands in a trusted pattern and has a trusted shape is an identifier too.

Positions come from splitting a text by an expression: the lengths of the pieces between the
matches add up to where each match starts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from questlake.llm.common import lookup, written

KINDS = ("email", "ip", "card", "phone", "id")
#: The contract's expressions. Quantifiers that cannot give anything back are possessive, and a
#: match starts where a run of its first characters does or where the last match ended, so that a
#: text is read once however long its runs are.
_LOCAL = r"[A-Za-z0-9._%+-]"
EXPRESSIONS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold if any match of a kind can count; looked for first, as most texts hold none of it.
#: Cards of fewer than four digits are too short to count, valid or not.
_MARKS = {
    "email": "@",
    "ip": r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){3}",
    "phone": r"\+[0-9]",
}
_BYTE = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: A token that may be an identifier: a run without separators that holds two digits.
_SEPARATORS = r"""\x00-\x20="'(),;:<>\[\]{}|"""
_RUN = rf"[^{_SEPARATORS}]"
_TOKEN = rf"(?<!{_RUN})[^{_SEPARATORS}0-9]*+[0-9][^{_SEPARATORS}0-9]*+[0-9]{_RUN}*+"
_TOKEN_MARK = rf"[0-9][^{_SEPARATORS}0-9]*+[0-9]"
#: Letters that a pattern's word is looked for in, and lengths of what can be an identifier.
_CONTEXT, _SHORTEST, _LONGEST = 80, 6, 128
#: Rounds of scoring; seeds that a pattern needs; how far a pattern and a shape must be trusted.
ROUNDS, SUPPORT, TRUSTED = 4, 5, 0.5


def _luhn(digits: Column) -> Column:
    places = F.transform(
        F.split(digits, ""),
        lambda d, at: F.when(
            F.pmod(F.length(digits) - at, F.lit(2)) == 0, d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)
        ).otherwise(d.cast("int")),
    )
    return F.aggregate(places, F.lit(0), lambda total, d: total + d) % 10 == 0


def _valid(kind: Column, hit: Column) -> Column:
    digits = F.regexp_replace(hit, "[^0-9]", "")
    card = F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    ip = hit.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    return F.when(kind == 0, True).when(kind == 1, ip).when(kind == 2, card).when(kind == 3, F.length(digits).between(8, 15)).otherwise(True)


def _hits(expression: str, mark: str) -> Column:
    """Matches in the texts that hold ``mark``, NULL for the others."""
    marked = F.contains("text", F.lit(mark)) if len(mark) == 1 else F.col("text").rlike(mark)
    return F.when(marked, F.regexp_extract_all("text", F.lit(expression), F.lit(0)))


def _matches(kind: int, expression: str, hits: Column) -> Column:
    """``hits`` of a kind, each with the length of the text between it and the match before."""
    gaps = F.transform(F.split("text", expression, -1), F.length)
    none = F.lit(None).cast("string")
    return F.zip_with(
        F.transform(hits, lambda hit, at: F.struct(at.alias("at"), hit.alias("hit"))),
        F.slice(gaps, F.lit(1), F.size(hits)),
        lambda h, gap: F.struct(F.lit(kind).alias("kind"), h["at"].alias("at"), h["hit"].alias("hit"), gap.alias("gap"), none.alias("before"), none.alias("after")),
    )


def _tokens(kind: int, hits: Column) -> Column:
    """As ``_matches``, of tokens, with the words before and after each."""
    word_before = lambda p: F.lower(F.regexp_extract(F.right(p, F.lit(_CONTEXT)), rf"({_RUN}+)[{_SEPARATORS}]*$", 1))
    word_after = lambda p: F.lower(F.regexp_extract(F.left(p, F.lit(_CONTEXT)), rf"^[{_SEPARATORS}]*({_RUN}+)", 1))
    pieces = F.transform(F.split("text", _TOKEN, -1), lambda p: F.struct(F.length(p).alias("gap"), word_before(p).alias("before"), word_after(p).alias("after")))
    firsts = F.slice(pieces, F.lit(1), F.size(hits))
    lasts = F.slice(pieces, F.lit(2), F.size(hits))
    around = F.zip_with(firsts, lasts, lambda p, q: F.struct(p["gap"].alias("gap"), p["before"].alias("before"), q["after"].alias("after")))
    return F.zip_with(
        F.transform(hits, lambda hit, at: F.struct(at.alias("at"), hit.alias("hit"))),
        around,
        lambda h, p: F.struct(F.lit(kind).alias("kind"), h["at"].alias("at"), h["hit"].alias("hit"), p["gap"].alias("gap"), p["before"].alias("before"), p["after"].alias("after")),
    )


def _shape(token: Column) -> Column:
    """Runs of letters, of digits and of both become one sign each; with the length's power of two."""
    mixed = F.regexp_replace(token, r"(?=[A-Za-z]*[0-9])(?=[0-9]*[A-Za-z])[A-Za-z0-9]++", "⊕")
    plain = F.regexp_replace(F.regexp_replace(mixed, r"[\p{L}]++", "a"), "[0-9]++", "9")
    return F.concat(plain, F.lit(":"), F.floor(F.log2(F.length(token))).cast("string"))


def _scores(edges: DataFrame, rounds: int, support: int) -> tuple[DataFrame, DataFrame]:
    """Trust in patterns and in shapes, from how often a pattern holds a seed (``seeds``) or another
    token of a shape (``others``)."""
    edges = written(edges, "edges")
    n_edges = edges.count()
    patterns = edges.groupBy("pattern").agg(F.sum("seeds").alias("seeds"), F.sum("others").alias("others")).where(F.col("seeds") >= support)
    patterns = written(patterns, "patterns")
    open_ = edges.where("others > 0")
    busy = {c: open_.groupBy(c).count().where(F.col("count") * 1000 > n_edges).select(c) for c in ("pattern", "shape")}

    def met(column: str, scored: DataFrame) -> DataFrame:
        hot = scored.join(F.broadcast(busy[column]), column, "left_semi")
        return lookup(open_, scored, column, hot, ["trust"])

    trust = F.col("seeds") / (F.col("seeds") + F.col("others") + 2)
    of_patterns = written(patterns.select("pattern", trust.alias("trust")), "trust")
    for _ in range(rounds):
        told = met("pattern", of_patterns).where("trust IS NOT NULL").groupBy("shape")
        average = F.sum(F.col("others") * F.col("trust")) / (F.sum("others") + 4)
        of_shapes = written(told.agg(average.alias("trust")).where("shape NOT LIKE '!%'"), "trust")
        gained = met("shape", of_shapes).groupBy("pattern").agg(F.sum(F.col("others") * F.coalesce("trust", F.lit(0.0))).alias("gained"))
        share = (F.col("seeds") + F.coalesce("gained", F.lit(0.0))) / (F.col("seeds") + F.col("others") + 2)
        of_patterns = written(patterns.join(gained, "pattern", "left").select("pattern", share.alias("trust")), "trust")
    return of_patterns, of_shapes


def find_personal_data(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS, support: int = SUPPORT, trusted: float = TRUSTED
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``row`` (its number in the input) and ``spans``, an array of
    ``(kind, start, end)`` by kind and start; kinds are places in ``KINDS``, positions are characters.

    Kinds 0 to 3 are the fixed forms, found without the rest; kind 4 are identifiers found by their
    context, none of which overlaps one of the others or is a number that failed as one of them. NULL and empty texts have none. Rows that
    repeat an id, or have none, are rows of their own. Words of a context longer than 80 characters
    count by their nearest 80, and tokens of over 128 characters are no identifiers by context.
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    # A text is split by an expression only if that matches in it. Hits are columns of their own, so that none is looked for twice.
    hits = {f"hits{at}": _hits(EXPRESSIONS[kind], _MARKS[kind]) for at, kind in enumerate(KINDS[:4])}
    marked = texts.withColumns(hits | {"hits4": _hits(_TOKEN, _TOKEN_MARK)})
    pieces = [*[_matches(at, EXPRESSIONS[kind], F.col(f"hits{at}")) for at, kind in enumerate(KINDS[:4])], _tokens(4, F.col("hits4"))]
    none = F.expr("cast(array() AS array<struct<kind:int,at:int,hit:string,gap:int,before:string,after:string>>)")
    found = F.concat(*[F.when(F.size(f"hits{at}") > 0, piece).otherwise(none) for at, piece in enumerate(pieces)])
    scanned = written(marked.select("doc_id", "row", found.alias("found")), "matches")

    each = scanned.where("size(found) > 0").select("row", F.inline("found"))
    end = F.sum(F.col("gap") + F.length("hit")).over(Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    each = written(each.withColumn("end", end).withColumn("start", F.col("end") - F.length("hit")), "places")
    span = F.struct("kind", "start", "end").alias("span")
    forms = each.where("kind < 4").withColumn("valid", _valid(F.col("kind"), F.col("hit")))
    forms = forms.where(F.col("valid") | (F.length("hit") >= _SHORTEST)).groupBy("row")
    picked = {"base": F.col("valid"), "failed": ~F.col("valid")}
    base = written(forms.agg(*[F.array_sort(F.collect_list(F.when(which, span))).alias(name) for name, which in picked.items()]), "base")

    lead = F.length("hit") - F.length(F.regexp_replace("hit", r"^[^0-9A-Za-z]+", ""))
    core = F.regexp_replace(F.regexp_replace("hit", r"^[^0-9A-Za-z]+", ""), r"(?<![^0-9A-Za-z])[^0-9A-Za-z]++$", "")
    tokens = each.where((F.col("kind") == 4) & (F.length("hit") <= _LONGEST)).withColumns({"core": core, "start": F.col("start") + lead})
    tokens = tokens.withColumn("end", F.col("start") + F.length("core")).where(F.length("core") >= _SHORTEST)
    none = F.expr("cast(array() AS array<struct<kind:int,start:bigint,end:bigint>>)")
    overlaps = F.exists(F.coalesce("base", none), lambda s: (s["start"] < F.col("end")) & (s["end"] > F.col("start")))
    # A number that has a fixed form but fails its check speaks against its pattern, and is never trusted.
    fails = F.exists(F.coalesce("failed", none), lambda s: (s["start"] <= F.col("start")) & (s["end"] >= F.col("end")))
    shape = F.concat(F.when(fails, F.lit("!")).otherwise(F.lit("")), _shape(F.col("core")))
    patterns = F.filter(
        F.array(F.when(F.col("before") != "", F.concat(F.lit("<"), "before")), F.when(F.col("after") != "", F.concat(F.lit(">"), "after"))), lambda p: p.isNotNull()
    )
    tokens = tokens.join(base, "row", "left").select("row", "start", "end", shape.alias("shape"), overlaps.alias("seed"), patterns.alias("patterns"))
    tokens = written(tokens, "tokens")

    edges = tokens.select(F.explode("patterns").alias("pattern"), "shape", "seed").groupBy("pattern", "shape")
    edges = edges.agg(F.sum(F.col("seed").cast("long")).alias("seeds"), F.sum((~F.col("seed")).cast("long")).alias("others"))
    of_patterns, of_shapes = _scores(edges, rounds, support)

    good = of_shapes.where(F.col("trust") >= trusted).select("shape", F.col("trust").alias("of_shape"))
    believed = of_patterns.where(F.col("trust") >= trusted).select("pattern", F.col("trust").alias("of_pattern"))
    open_ = tokens.where("NOT seed")
    n_open = open_.count()
    busy = open_.groupBy("shape").count().where(F.col("count") * 1000 > n_open)
    shaped = lookup(open_, good, "shape", good.join(F.broadcast(busy), "shape", "left_semi"), ["of_shape"]).where("of_shape IS NOT NULL")
    placed = shaped.select("row", "start", "end", F.explode("patterns").alias("pattern"))
    busy = placed.groupBy("pattern").count().where(F.col("count") * 1000 > n_open)
    more = lookup(placed, believed, "pattern", believed.join(F.broadcast(busy), "pattern", "left_semi"), ["of_pattern"])
    more = more.where("of_pattern IS NOT NULL").select("row", F.struct(F.lit(4).alias("kind"), "start", "end").alias("span"))
    more = more.groupBy("row").agg(F.array_sort(F.collect_set("span")).alias("more"))

    spans = F.concat(F.coalesce("base", none), F.coalesce("more", none))
    return scanned.select("doc_id", "row").join(base.select("row", "base"), "row", "left").join(more, "row", "left").select("doc_id", "row", spans.alias("spans"))
