"""Recurring lines by a log-template tree of fixed depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellweave.llm.common import hot_join, may_match
from cellweave.session import cut_lineage

#: Leading tokens that lead to a leaf, below the token count.
DEPTH = 3
#: Distinct texts in which a template must stand to be recurring.
MIN_TEXTS = 10
#: Share of a leaf's texts that a token must have at its place to be part of a template.
SHARE = 0.1
#: Share of a line's tokens that its template must keep.
SIMILAR = 0.7
#: Shorter lines are left alone; blank lines have no token.
MIN_TOKENS = 1

col, lit = F.col, F.lit
SPACE = r"[ \t\x0B\f\r]+"
#: Lines of ``DEPTH`` tokens or more.
LONG = r"^[ \t\x0B\f\r]*+(?:[^ \t\x0B\f\r]++(?:[ \t\x0B\f\r]++|$)){%d}" % DEPTH


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def tokens_of(line: Column) -> Column:
    """Tokens by white space; one with a digit is a variable field, ``<*>``, in lines of ``DEPTH`` tokens or more."""
    masked = F.when(
        line.rlike("[0-9]") & line.rlike(LONG), F.regexp_replace(line, r"(?<![^ \t\x0B\f\r])[^ \t\x0B\f\r0-9]*+[0-9][^ \t\x0B\f\r]*+", "<*>")
    ).otherwise(line)
    return F.filter(F.split(masked, SPACE), lambda t: t != "")


def _leaf(tokens: Column) -> Column:
    return F.xxhash64(F.size(tokens), F.slice(tokens, 1, DEPTH))


def drop_recurring_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_texts: int = MIN_TEXTS,
    share: float = SHARE,
    similar: float = SIMILAR,
    min_tokens: int = MIN_TOKENS,
    into: str = "dropped",
) -> DataFrame:
    """``docs`` without lines whose template recurs; the column ``into`` holds their places, from 0.

    The tree has a level for the token count and one for each of the ``DEPTH`` leading tokens;
    tokens with digits are variable from the start, but in lines of fewer than ``DEPTH`` tokens,
    of which only exact recurrences go.  Below a leaf, a token is constant at its
    place if ``min_texts`` texts and a ``share`` of the leaf's texts have it there; the others are
    variable fields.  A line whose constant tokens are ``similar`` of all has these as its
    template; any other line is its own template.  A template in at least ``min_texts`` different
    texts recurs: its first line (by id, then place) stays, all others go.

    Copies of one text count once, so a copied document is not taken for boilerplate.  NULL texts
    stay NULL, blank lines and lines of fewer than ``min_tokens`` tokens stay; a text whose lines
    all go becomes empty, and the row stays.  Repeated rows are treated alike: if one of them holds
    the first line, all keep it.  NULL ids sort first.  An empty table gives an empty one.  Other
    columns pass unchanged.

    Texts of which a line is wanted move once, to fetch one line of each distinct form in leaves that
    recur, and texts that may lose a line move once to be rewritten; all counting moves hashes.
    """
    text = col(text_col).cast("string")
    key = [col(id_col).alias("id"), F.xxhash64(text).alias("h")]
    who = docs.select(*key, F.posexplode(lines_of(text)).alias("pos", "line"))
    cut = who.select("id", "h", "pos", tokens_of(col("line")).alias("t")).where(F.size("t") >= min_tokens)
    lines = cut_lineage(cut.select("id", "h", "pos", _leaf(col("t")).alias("leaf"), F.xxhash64("t").alias("body")))

    # leaves in enough texts; forms (leaf and body) in them, with their texts and one place to read them
    forms = lines.groupBy("leaf", "body", "h").agg(F.min(F.struct("id", "pos")).alias("at"), F.count("*").alias("rows"))
    forms = cut_lineage(
        forms.groupBy("leaf", "body").agg(
            F.count("*").alias("texts"), F.min(F.struct("at.id", "h", "at.pos")).alias("at"), F.sum("rows").alias("rows")
        )
    )
    in_leaf = lines.select("leaf", "h").distinct().groupBy("leaf").agg(F.count("*").alias("leaf_texts"))
    of_forms = forms.groupBy("leaf").agg(F.count("*").alias("n_forms"))
    leaves = in_leaf.where(col("leaf_texts") >= min_texts).join(of_forms, "leaf")
    live = hot_join(forms, leaves, "leaf", "n_forms", forms.count())
    live = cut_lineage(live.select("leaf", "body", "texts", "rows", "leaf_texts", col("at.id").alias("id"), col("at.h").alias("h"), col("at.pos").alias("pos")))

    # their tokens, from one shuffle of the texts
    wanted = live.groupBy(col("id").alias("w_id"), col("h").alias("w_h")).agg(
        F.collect_list(F.struct("pos", "leaf", "body", "texts", "leaf_texts")).alias("forms")
    )
    texts, flag = may_match(docs.select(*key, text.alias("text")), col("h"), live, "h", live.count())
    texts = texts.where(col(flag).isNotNull()).drop(flag)
    read = wanted.join(texts, col("id").eqNullSafe(col("w_id")) & (col("h") == col("w_h"))).select(
        lines_of(col("text")).alias("all"), F.explode("forms").alias("f")
    )
    tokens = read.select(
        "f.leaf", "f.body", "f.texts", "f.leaf_texts", F.posexplode(tokens_of(F.get(col("all"), col("f.pos")))).alias("place", "token")
    )
    tokens = tokens.select("leaf", "body", "texts", "leaf_texts", "place", F.xxhash64("leaf", "place", "token").alias("key"))
    tokens = cut_lineage(tokens.dropDuplicates(["leaf", "body", "place"]))
    constant = (
        tokens.groupBy("key")
        .agg(F.sum("texts").alias("n"), F.first("leaf_texts").alias("leaf_texts"), F.count("*").alias("n_key"))
        .where((col("n") >= min_texts) & (col("n") >= share * col("leaf_texts")))
        .select("key", "n_key", lit(True).alias("constant"))
    )
    marked = hot_join(tokens, constant, "key", "n_key", tokens.count(), how="left")
    kept = marked.groupBy("leaf", "body").agg(
        F.count("*").alias("n"),
        F.count("constant").alias("n_constant"),
        F.xxhash64(F.array_sort(F.collect_list(F.when(col("constant"), F.struct("place", "key"))))).alias("pattern"),
    )
    template = F.when(col("n_constant") >= similar * col("n"), F.xxhash64("leaf", "pattern")).otherwise(F.xxhash64("leaf", "body", lit("own")))
    named = kept.select(col("leaf").alias("k_leaf"), col("body").alias("k_body"), template.alias("template"))
    sizes = live.select("leaf", "body", "rows")
    named = cut_lineage(
        named.join(sizes, (col("k_leaf") == col("leaf")) & (col("k_body") == col("body"))).select(
            F.xxhash64("leaf", "body").alias("form"), "template", "rows"
        )
    )

    # templates in enough texts, and their lines but the first
    total = lines.count()
    mine = lines.select("id", "h", "pos", F.xxhash64("leaf", "body").alias("form"))
    mine = cut_lineage(hot_join(mine, named, "form", "rows", total))
    seen = mine.groupBy("template", "h").agg(F.min(F.struct("id", "pos")).alias("at"), F.count("*").alias("n_rows"))
    recurring = seen.groupBy("template").agg(
        F.count("*").alias("n_texts"), F.min(F.struct("at.id", "h", "at.pos")).alias("first"), F.sum("n_rows").alias("n_rows")
    ).where(col("n_texts") >= min_texts)
    found = hot_join(mine, recurring, "template", "n_rows", total)
    drops = (
        found.where(~F.struct("id", "h", "pos").eqNullSafe(col("first")))
        .groupBy(col("id").alias("d_id"), col("h").alias("d_h"))
        .agg(F.collect_set("pos").alias("gone"))
    )
    drops = cut_lineage(drops)
    # rows that lose no line, as far as the filter can tell, stay where they are
    rows, flag = may_match(docs.select(*key, F.struct("*").alias("row")), col("h"), drops, "d_h", drops.count())
    moved = rows.where(col(flag).isNotNull()).join(drops, col("id").eqNullSafe(col("d_id")) & (col("h") == col("d_h")), "left")
    stay = rows.where(col(flag).isNull()).select("row", lit(None).cast("array<int>").alias("gone"))
    out = moved.select("row", "gone").unionByName(stay)
    old = col("row").getField(text_col).cast("string")
    rest = F.array_join(F.filter(lines_of(old), lambda line, i: ~F.array_contains(col("gone"), i)), "\n")
    new = F.when(col("gone").isNull(), old).otherwise(rest)
    return out.select(
        *[(new if c == text_col else col("row").getField(c)).alias(c) for c in docs.columns],
        F.coalesce(F.array_sort("gone"), F.array().cast("array<int>")).alias(into),
    )
