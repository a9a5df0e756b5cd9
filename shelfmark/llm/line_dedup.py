"""Recurring lines dropped by a tree of line templates; DataFrame operations only.

A line is parsed like a log line. Tokens with a digit become ``<*>``. The tree has a
fixed depth: first the number of tokens, then the leading tokens; lines that reach the
same leaf are candidates for one template. A leaf holds any number of templates: shapes
of a leaf that resemble each other, and what these resemble in turn, are a template.
Shapes resemble each other if enough of their tokens are equal, place by place; the
places where they differ are the template's variable fields.

Candidates. Shapes of n tokens may differ in d places. The places after the leading
tokens are dealt into d + 1 bands, so two shapes that resemble each other agree in one
band at least. Bands are compared as hashes. First, a shape meets the commonest shape
that has its tokens in a band, and the commonest that has its tokens in all bands but
one, which connects most of what is alike.

Then what agrees in a band and is still apart is compared: all members outside the
band's largest template with all others. A crowd, where these are many, is first split:
the places where its members differ are dealt into d + 1 bands again, in one of which
two that resemble each other agree, and each of its members meets the first of its part.
Parts that still hold several templates go the same way, so no link is left out.

A template found in ``min_documents`` documents or more is boilerplate: its first line,
by (doc_id, line), stays and all others are dropped. Lines under ``min_tokens`` tokens
have no variable fields, and must stand in ``short_documents`` documents. Lines that are
mostly numbers are never dropped.

Lines are counted and joined as hashes. The texts are shuffled twice: to read the
shapes of leaves that have several, and to drop the lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import key128, store
from shelfmark.llm.components import components

WILD = "<*>"
#: Members outside a group's largest template that are compared with all others of it,
#: for each band: more are a crowd.
CROWD = 16
#: Times that a crowd is split before its parts are compared as they are.
SPLITS = 4
#: Members that one part of a comparison holds of the side that is dealt over parts.
PART = 1024
_TOKENS = "[ \\t-\\r]+"
#: A token with a digit, looked for where tokens start alone.
_VARIABLE = "(?<![^ \\t-\\r])[^ \\t-\\r0-9]*+[0-9][^ \\t-\\r]*+"
#: Without these, and without two spaces in a row, a line is its tokens as they stand.
_ODD = "[0-9<\\t-\\r]"


@dataclass(frozen=True)
class Settings:
    #: Leading tokens that lead to a leaf.
    depth: int = 3
    #: Least share of equal tokens for two lines to share a template.
    similarity: float = 0.75
    min_tokens: int = 5
    #: Least number of documents for a line of fewer tokens.
    short_documents: int = 20
    #: Least share of tokens without a digit.
    constant: float = 0.5
    min_documents: int = 3


def _tokens(line: Column) -> Column:
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, _VARIABLE, WILD)).otherwise(line)
    return F.array_remove(F.split(masked, _TOKENS), "")


def _said(line: Column) -> Column:
    """A line's tokens with a space between them, their number, and the number of those
    without a digit: (said, size, constant). Most lines need not be cut for it."""

    def laid(said: Column, size: Column, constant: Column) -> Column:
        return F.struct(said.alias("said"), size.alias("size"), constant.alias("constant"))

    def read(tokens: Column) -> Column:
        return laid(F.array_join(tokens, " "), F.size(tokens), F.size(F.array_remove(tokens, WILD)))

    plain = F.trim(line)
    spaces = F.octet_length(plain) - F.octet_length(F.replace(plain, F.lit(" "), F.lit("")))
    size = F.when(plain == "", 0).otherwise(spaces + 1)
    odd = line.rlike(_ODD) | F.contains(line, F.lit("  "))
    # The tokens are bound to a name once, by a transform of a single element; the constant
    # of a plain line is its size.
    cut = F.transform(F.array(_tokens(line)), read)[0]
    return F.when(odd, cut).otherwise(laid(plain, size, F.lit(None).cast("int")))


def _hashes(name: str, *columns: Column) -> list[Column]:
    return [c.alias(f"{name}_{side}") for c, side in zip(key128(*columns), "ab")]


def _lines(docs: DataFrame, settings: Settings) -> DataFrame:
    """Lines with words: the document's key, doc_id, line, size, leaf and shape."""
    # Hashed before the lines part, once for a document.
    docs = docs.select("doc_id", "text", *_hashes("doc", F.col("doc_id"), F.col("text")))
    # Parsed inside the generator, so that no filter parses them again.
    lines = docs.select("doc_id", "doc_a", "doc_b", F.posexplode(F.transform(F.split("text", "\n"), _said)).alias("line", "x"))
    lines = lines.select("doc_id", "doc_a", "doc_b", "line", "x.*")
    constant = F.coalesce("constant", "size")
    lines = lines.where((F.col("size") > 0) & (constant >= settings.constant * F.col("size")))
    lead = F.substring_index("said", " ", settings.depth) if settings.depth else F.lit("")
    return lines.select(
        "doc_id", "doc_a", "doc_b", "line", "size", *_hashes("leaf", F.col("size"), lead), *_hashes("shape", F.col("said"))
    )


_LEAF, _SHAPE, _DOC = ("leaf_a", "leaf_b"), ("shape_a", "shape_b"), ("doc_a", "doc_b")
_BAND = ("band_a", "band_b")


def _shape_tokens(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` shapes with the tokens of the line that each was first seen in."""
    fields = (*_LEAF, *_SHAPE, "rank")
    asked = wanted.groupBy(*_DOC).agg(F.collect_list(F.struct(*fields, "place")).alias("asked"))
    texts = docs.select("text", *_hashes("doc", F.col("doc_id"), F.col("text"))).join(asked, [*_DOC])

    def read(lines: Column) -> Column:
        return F.transform("asked", lambda x: x.withField("said", F.get(lines, x["place"]["line"])))

    found = F.explode(F.transform(F.array(F.split("text", "\n")), read)[0])
    found = texts.select(found.alias("x")).select("x.*")
    # Equal rows of documents give the same shape more than once.
    first = found.groupBy(*fields).agg(F.first("place").alias("place"), F.first("said").alias("said"))
    return first.select(*fields, "place", _tokens(F.col("said")).alias("tokens"))


def _bands(settings: Settings) -> Column:
    """Pairs of a number and a hash by which a shape finds others: of the tokens in each
    band, and of those in all bands but one."""
    size = F.size("tokens")
    bands = size - F.ceil(F.lit(settings.similarity) * size).cast("int") + 1
    rest = F.slice("tokens", settings.depth + 1, F.greatest(size - settings.depth, F.lit(0)))
    numbers = F.sequence(F.lit(0), bands - 1)

    def together(values: Column, places: Column | None = None) -> Column:
        """The hashes at some places, of any order, as one."""
        picked = values if places is None else F.transform(places, lambda i: F.get(values, i))
        none = F.lit(0).cast("bigint")
        return F.aggregate(picked, none, lambda held, x: held.bitwiseXOR(F.coalesce(x, none)))

    def banded(hashes: Column) -> Column:
        last = F.size(hashes) - 1
        return F.transform(numbers, lambda j: together(hashes, F.sequence(j, F.greatest(last, j), bands)))

    def named(inside: Column) -> Column:
        one = F.transform(inside, lambda x, j: F.struct(j.alias("at"), x.alias("held")))
        # Of two bands, all but one is the other.
        others = F.transform(
            F.transform(F.array(together(inside)), lambda whole: F.transform(inside, lambda x: whole.bitwiseXOR(x)))[0],
            lambda x, j: F.struct((-j - 1).alias("at"), x.alias("held")),
        )
        return F.when(bands > 2, F.concat(one, others)).otherwise(one)

    # Each step is bound to a name once, by a transform of a single element.
    hashed = F.transform(rest, lambda token, i: F.xxhash64(token, i))
    return F.transform(F.transform(F.array(hashed), banded), named)[0]


def _shared(held: DataFrame, settings: Settings) -> DataFrame:
    """The bands that several shapes have: the shape, the band's key, whether it is one
    band (not all but one), and as head the commonest shape that has it."""
    found = held.select(*_LEAF, *_SHAPE, "rank", "place", F.explode(_bands(settings)).alias("band"))
    found = found.select(
        *_SHAPE, *_hashes("band", F.col("leaf_a"), F.col("leaf_b"), F.col("band")),
        (F.col("band.at") >= 0).alias("single"), "rank", "place",
    )
    found = store(found, "bands")
    best = F.min(F.struct("rank", "place", *_SHAPE)).alias("head")
    heads = found.groupBy(*_BAND).agg(F.count(F.lit(1)).alias("shapes"), best)
    heads = store(heads.where("shapes > 1").drop("shapes"), "heads")
    return store(found.drop("rank", "place").join(heads, [*_BAND]), "shared")


def _equal(settings: Settings) -> Column:
    """Whether ``tokens`` and ``model``, of one length, are equal in enough places."""
    equal = F.size(F.filter(F.zip_with("tokens", "model", lambda a, b: a == b), lambda same: same))
    return equal >= F.lit(settings.similarity) * F.size("model")


def _alike(met: DataFrame, held: DataFrame, settings: Settings) -> DataFrame:
    """The rows of ``met`` (a shape, and another as head) that resemble each other."""
    met = met.withColumns({"up_a": F.col("head.shape_a"), "up_b": F.col("head.shape_b")})
    tokens = held.select(*_SHAPE, "tokens")
    models = held.select(F.col("shape_a").alias("up_a"), F.col("shape_b").alias("up_b"), F.col("tokens").alias("model"))
    like = met.join(tokens, [*_SHAPE]).join(models, ["up_a", "up_b"])
    return like.where(_equal(settings)).drop("up_a", "up_b", "tokens", "model")


def _resembled(shared: DataFrame, held: DataFrame, settings: Settings) -> DataFrame:
    """For each of the shapes that resembles a commoner one: the shape, and as up_a, up_b
    the commonest that it meets."""
    met = shared.where("head.shape_a <> shape_a or head.shape_b <> shape_b").select(*_SHAPE, "head").distinct()
    return _alike(met, held, settings).groupBy(*_SHAPE).agg(F.min("head").alias("head")).select(
        *_SHAPE, F.col("head.shape_a").alias("up_a"), F.col("head.shape_b").alias("up_b")
    )


def _roots(links: DataFrame) -> DataFrame:
    """``links`` (shape to a commoner one) followed to their ends, twice as far in each
    round."""
    links = store(links, "links")
    while True:
        further = links.select(
            F.col("shape_a").alias("up_a"), F.col("shape_b").alias("up_b"),
            F.col("up_a").alias("end_a"), F.col("up_b").alias("end_b"),
        )
        joined = links.join(further, ["up_a", "up_b"], "left")
        moved = store(
            joined.select(
                *_SHAPE, F.coalesce("end_a", "up_a").alias("up_a"), F.coalesce("end_b", "up_b").alias("up_b"),
                F.col("end_a").isNotNull().alias("moved"),
            ),
            "links",
        )
        links = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return links


def _compared(members: DataFrame, settings: Settings) -> DataFrame:
    """Templates (a, b) that ``members`` of one group connect: all members outside the
    group's largest template are compared with all of it."""
    parts = F.ceil(F.col("apart") / PART)
    one = members.where("up <> largest").select(
        *_BAND, F.pmod(F.xxhash64(*_SHAPE), parts).alias("part"), F.col("up").alias("a"), "tokens"
    )
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), parts - 1)).alias("part")
    other = members.select(*_BAND, every, F.col("up").alias("b"), F.col("tokens").alias("model"))
    met = one.join(other, [*_BAND, "part"]).where(F.col("a") != F.col("b"))
    return met.where(_equal(settings)).select("a", "b").distinct()


def _split(crowds: DataFrame, bands: Column) -> DataFrame:
    """Groups of ``crowds`` by the tokens in each of ``bands`` parts of the places where
    a crowd's members differ: the shape, its template and the new group's key."""
    tokens = crowds.select(*_BAND, F.posexplode("tokens").alias("at", "token"))
    differ = tokens.groupBy(*_BAND, "at").agg(F.min("token").alias("least"), F.max("token").alias("most"))
    differ = differ.where("least <> most").groupBy(*_BAND).agg(F.sort_array(F.collect_list("at")).alias("places"))
    parts = F.explode(F.sequence(F.lit(0), bands - 1)).alias("part")
    dealt = crowds.join(differ, [*_BAND]).select(*_SHAPE, "up", *_BAND, "tokens", "places", bands.alias("bands"), parts)
    own = F.filter("places", lambda place, i: F.pmod(i, F.col("bands")) == F.col("part"))
    said = F.transform(own, lambda place: F.get("tokens", place))
    return dealt.select(*_SHAPE, "up", *_hashes("band", F.col("band_a"), F.col("band_b"), F.col("part"), said))


def _completed(roots: DataFrame, shared: DataFrame, held: DataFrame, settings: Settings) -> DataFrame:
    """``roots`` (shape to its template's) with all templates joined that hold two shapes
    which resemble each other."""
    size = F.size("tokens")
    bands = size - F.ceil(F.lit(settings.similarity) * size).cast("int") + 1
    groups = shared.where("single").select(*_SHAPE, *_BAND)
    for split in range(SPLITS + 1):
        up = F.struct(F.coalesce("up_a", "shape_a").alias("a"), F.coalesce("up_b", "shape_b").alias("b"))
        groups = groups.join(roots, [*_SHAPE], "left").select(*_SHAPE, *_BAND, up.alias("up"))
        cells = groups.groupBy(*_BAND, "up").agg(F.count(F.lit(1)).alias("members"))
        spread = cells.groupBy(*_BAND).agg(
            F.count(F.lit(1)).alias("templates"), F.max_by("up", "members").alias("largest"),
            (F.sum("members") - F.max("members")).alias("apart"),
        )
        spread = spread.where("templates > 1").drop("templates")
        members = store(groups.join(spread, [*_BAND]).join(held.select(*_SHAPE, "tokens"), [*_SHAPE]), "apart")
        if members.isEmpty():
            break
        crowded = (F.col("apart") > CROWD * bands) if split < SPLITS else F.lit(False)
        links = _compared(members.where(~crowded), settings)
        crowds = members.where(crowded)
        last = crowds.isEmpty()
        if not last:
            groups = store(_split(crowds, bands), "groups")
            heads = groups.groupBy(*_BAND).agg(
                F.min(F.struct(*_SHAPE, "up")).alias("head"), F.min("up").alias("least"), F.max("up").alias("most")
            )
            heads = heads.where("least <> most").select(*_BAND, "head")
            met = groups.join(heads, [*_BAND]).where("head.up <> up").select(*_SHAPE, "up", "head").distinct()
            alike = _alike(met, held, settings).select(F.col("up").alias("a"), F.col("head.up").alias("b"))
            links = links.union(alike)
            groups = groups.drop("up")
        links = store(links, "links")
        if not links.isEmpty():
            # Below 0, all in DataFrame operations.
            joined = components(links, settled=-1)
            joined = store(joined.where("id <> component"), "joined")
            moved = roots.join(joined, F.struct(F.col("up_a").alias("a"), F.col("up_b").alias("b")) == F.col("id"), "left")
            moved = moved.select(
                *_SHAPE, F.coalesce("component.a", "up_a").alias("up_a"), F.coalesce("component.b", "up_b").alias("up_b")
            )
            ends = joined.select(
                F.col("id.a").alias("shape_a"), F.col("id.b").alias("shape_b"),
                F.col("component.a").alias("up_a"), F.col("component.b").alias("up_b"),
            )
            roots = store(moved.union(ends), "roots")
        if last:
            break
    return roots


def line_templates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every line with its template: doc_id, doc_a, doc_b, line, size, template_a, template_b."""
    narrow = store(_lines(docs, settings), "lines")
    shapes = narrow.where(F.col("size") >= settings.min_tokens).groupBy(*_LEAF, *_SHAPE).agg(
        F.negative(F.count(F.lit(1))).alias("rank"), F.min(F.struct("doc_id", "line", *_DOC)).alias("place")
    )
    # A leaf with one shape has nothing to generalise.
    leaves = shapes.groupBy(*_LEAF).agg(F.count(F.lit(1)).alias("shapes"))
    mixed = leaves.where("shapes > 1").select(*_LEAF)
    wanted = shapes.join(mixed, [*_LEAF]).select(*_LEAF, *_SHAPE, "rank", "place", "place.doc_a", "place.doc_b")
    held = store(_shape_tokens(docs, wanted), "shapes")
    shared = _shared(held, settings)
    roots = _completed(_roots(_resembled(shared, held, settings)), shared, held, settings)
    placed = narrow.join(roots, [*_SHAPE], "left")
    template = [F.coalesce(f"up_{s}", f"shape_{s}").alias(f"template_{s}") for s in "ab"]
    return placed.select("doc_id", *_DOC, "line", "size", *template)


def dropped_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """For each document that loses lines: doc_a, doc_b and the lines, from 0."""
    template = ("template_a", "template_b")
    lines = store(line_templates(docs, settings), "templates")
    # One row for each template and document, then one for each template.
    seen = lines.groupBy(*template, *_DOC).agg(
        F.min(F.struct("doc_id", "line")).alias("place"), F.first("size").alias("size")
    )
    first = F.min(F.struct("place", *_DOC)).alias("first")
    recurring = seen.groupBy(*template).agg(F.count(F.lit(1)).alias("documents"), F.first("size").alias("size"), first)
    least = F.when(F.col("size") < settings.min_tokens, settings.short_documents).otherwise(settings.min_documents)
    # Written, so that its size is known and the join can be broadcast or split by key.
    recurring = store(recurring.where(F.col("documents") >= least).drop("documents", "size"), "recurring")
    is_first = (
        (F.col("doc_a") == F.col("first.doc_a"))
        & (F.col("doc_b") == F.col("first.doc_b"))
        & (F.col("line") == F.col("first.place.line"))
    )
    drops = lines.join(recurring, [*template]).where(~is_first)
    # A document's own lines; equal rows of documents share theirs.
    return drops.groupBy(*_DOC).agg(F.collect_set("line").alias("dropped"))


def drop_recurring_lines(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(row, n_lines, n_dropped): each row of ``docs`` as a struct, its text without the
    recurring lines.

    A null text stays null and has no lines. Equal rows (doc_id and text) count as
    one document and are treated alike. Other columns are carried, whatever their names.
    """
    drops = dropped_lines(docs, settings)
    held = docs.select(F.struct(*docs.columns).alias("row"))
    keyed = held.select("row", *_hashes("doc", F.col("row.doc_id"), F.col("row.text")))
    keyed = keyed.join(drops, [*_DOC], "left")
    text = F.col("row.text")
    lines = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped"))
    left = F.transform(F.array(lines), lambda a: F.transform(kept, lambda i: F.get(a, i)))[0]
    rest = F.when(F.col("dropped").isNull(), text).otherwise(F.concat_ws("\n", left))
    return keyed.select(
        F.col("row").withField("text", rest).alias("row"),
        F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("bigint").alias("n_lines"),
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
    )


def op1_line_dedup(spark, docs: DataFrame) -> DataFrame:
    text = F.col("row.text")
    return drop_recurring_lines(docs.select("doc_id", "text")).select(
        "row.doc_id", "n_lines", "n_dropped",
        F.length(text).cast("bigint").alias("kept_chars"), F.md5(text).alias("kept_md5"),
    )
