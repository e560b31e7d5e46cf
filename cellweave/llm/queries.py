"""The registered query of every operator, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellweave.llm.archives import through_archives
from cellweave.llm.bpe import round_trip
from cellweave.llm.common import table
from cellweave.llm.decontaminate import matches
from cellweave.llm.fingerprint import compare_edited
from cellweave.llm.html_text import extract
from cellweave.llm.language import identify_held_out
from cellweave.llm.licences import scan
from cellweave.llm.line_dedup import drop_recurring_lines, lines_of
from cellweave.llm.lm_score import score_texts
from cellweave.llm.manifest import manifest
from cellweave.llm.near_dedup import near_duplicates
from cellweave.llm.sharding import shard_documents
from cellweave.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return add


#: Distinct word shingles of whole texts; a shorter text is one shingle.
SHINGLES = r"""
words as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < {k} then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - {k} + 2), lambda i: array_to_string(w[i:i + {k} - 1], ' ')) end) as s
  from words),
items as (select doc_id, unnest(s) as g from sets),
common as (
  select a.doc_id as x, b.doc_id as y, count(*) as n
  from items a join items b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (
  select x, y from common join sets a on a.doc_id = x join sets b on b.doc_id = y
  where 100 * n >= {t} * (len(a.s) + len(b.s) - n)),
ways as (select x, y from links union all select y, x from links),
reach(doc_id, root) as (
  select doc_id, doc_id from sets
  union select w.y, r.root from reach r join ways w on r.doc_id = w.x)"""

NEAR_SQL = (
    "with recursive "
    + SHINGLES.format(k=3, t=85)
    + """,
roots as (select doc_id, min(root) as component_id from reach group by doc_id)
select doc_id, cast(len(s) as bigint) as n_shingles, component_id, doc_id = component_id as kept
from sets join roots using (doc_id)"""
)


@query("op4_near_duplicates", NEAR_SQL)
def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), k=3, num=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


def tokenizer_path() -> str:
    """Where the public tokenizer's file lies; a package of the environment, not of this library."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = docs.select("doc_id", round_trip(spark, tokenizer_path())("text").alias("both"))
    return both.select("doc_id", "both.ids", "both.decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op3_language")
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_held_out(table(spark, sf_dir, "documents"))


@query("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard_documents(table(spark, sf_dir, "documents"), shards=40)
    return found.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op10_decontamination")
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = matches(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", F.explode("matches").alias("m")).select(
        "doc_id", F.col("m.item").alias("item_id"), "m.coverage", "m.matched", "m.tokens", "m.tiles"
    )


@query("op8_fingerprints")
def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_edited(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


LINES_SQL = r"""
with src as (
  select doc_id, text, string_split(text, chr(10)) as all_lines from documents),
cut as (
  select doc_id, text, pos, list_filter(regexp_split_to_array(line, '[ \t\x0B\f\r]+'), lambda t: t <> '') as raw
  from (select doc_id, text, unnest(all_lines) as line, unnest(range(len(all_lines))) as pos from src)),
lines as (
  select doc_id, text, pos, t, len(t) as n, concat(len(t), '|', array_to_string(t[1:3], '|')) as leaf, array_to_string(t, ' ') as body
  from (select *, list_transform(raw, lambda x: case when regexp_matches(x, '[0-9]') then '<*>' else x end) as t from cut)
  where len(t) >= 3),
leaves as (select leaf, count(distinct text) as leaf_texts from lines group by leaf having count(distinct text) >= 10),
forms as (
  select leaf, body, any_value(t) as t, any_value(n) as n, count(distinct text) as texts, any_value(leaf_texts) as leaf_texts
  from lines join leaves using (leaf) group by leaf, body),
places as (
  select leaf, body, texts, leaf_texts, n, unnest(t) as token, unnest(range(n)) as place from forms),
constant as (
  select leaf, place, token from places group by leaf, place, token
  having sum(texts) >= 10 and sum(texts) >= 0.1 * any_value(leaf_texts)),
patterns as (
  select p.leaf, p.body, any_value(n) as n, count(c.token) as n_constant,
    string_agg(concat(p.place, ':', c.token), ' ' order by p.place) filter (c.token is not null) as pattern
  from places p left join constant c on p.leaf = c.leaf and p.place = c.place and p.token = c.token
  group by p.leaf, p.body),
named as (
  select leaf, body, case when n_constant >= 0.7 * n then concat('pattern ', pattern) else concat('own ', body) end as template from patterns),
mine as (
  select doc_id, text, pos, concat(leaf, '#', template) as template from lines join named using (leaf, body)),
recurring as (select template from mine group by template having count(distinct text) >= 10),
ranked as (
  select doc_id, pos, row_number() over (partition by template order by doc_id, pos) as k
  from mine join recurring using (template)),
drops as (select doc_id, list_sort(list(pos)) as dropped from ranked where k > 1 group by doc_id)
select doc_id, cast(len(all_lines) as bigint) as n_lines, cast(coalesce(len(dropped), 0) as bigint) as n_dropped,
  case when dropped is null then text else array_to_string(list_transform(
    list_filter(range(len(all_lines)), lambda i: not list_contains(dropped, i)), lambda i: all_lines[i + 1]), chr(10)) end as text
from src left join drops using (doc_id)"""


@query("op2_line_dedup", LINES_SQL)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"))
    found = drop_recurring_lines(docs, min_tokens=3)  # as in the SQL; the pipeline takes shorter lines too
    return found.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), "text")


WARC_SQL = """
with p as (select page_id, coalesce(html, '') as html, sha1(coalesce(html, '')) as h from pages),
g as (select html, max(page_id) as first from p group by html)
select page_id, cast(octet_length(encode(p.html)) as bigint) as payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast(
    list_sum(list_transform(range(5), lambda j: cast((cast(concat('0x', substr(h, 1 + cast(floor((i * 5 + j) / 4) as bigint), 1)) as int)
      >> cast(3 - (i * 5 + j) % 4 as int)) & 1 as int) * (1 << cast(4 - j as int)))) as bigint), 1)), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id = first then null else first end as refers_to
from p join g on p.html = g.html"""


@query("op6_warc", WARC_SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return through_archives(table(spark, sf_dir, "pages"))


@query("op1_html_text")
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", extract(F.col("html")).alias("text"))


@query("op7_licences")
def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "license", F.array_join("notices", ",").alias("notices"))


#: crc32 of the decimal id, bit by bit, as DuckDB has no such function.
CRC_SQL = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ord(c)::bigint)),
  lambda r, c: list_reduce([xor(r, c), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, k: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295)"""


def _leaf_sql(text: str) -> str:
    parts = [f"coalesce(concat(octet_length(encode({f}::varchar)), ':', {f}), '-')" for f in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256(concat({', '.join(parts)}))"


def _level_sql(nodes: str, rows: str, i: int) -> str:
    """One level up: runs of 16 nodes become one, a lone node stays; rows fold their digest and add their siblings."""
    return f"""
{nodes}r{i} as (select tree, pos // 16 as up, list(d order by pos) as ds, any_value(n) as n
  from (select *, count(*) over (partition by tree) as n from {nodes}{i}) group by all),
{nodes}{i + 1} as (select tree, up as pos, case when n = 1 then ds[1] else sha256(array_to_string(ds, '')) end as d from {nodes}r{i}),
{rows}{i + 1} as (select doc_id, leaf, subroot, tree, up as pos, case when n = 1 then f else sha256(concat(l, f, r)) end as f, concat(proof, l, r) as proof
  from (select doc_id, leaf, subroot, tree, pos, f, proof, up, n, array_to_string(ds[1:pos % 16], '') as l, array_to_string(ds[pos % 16 + 2:], '') as r
    from {rows}{i} join {nodes}r{i} using (tree) where pos // 16 = up))"""


def manifest_sql(levels: int = 5, upper: int = 3) -> str:
    """SQL of the manifest for sources of up to ``16 ** levels`` rows, and ``16 ** upper`` sources."""
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""with docs as (select doc_id, coalesce('=' || source, '') as tree, {_leaf_sql("text")} as d,
  case when {CRC_SQL} % 5 = 0 then {_leaf_sql(lower)} else {_leaf_sql("text")} end as f from documents),
p as (select *, row_number() over (partition by tree order by doc_id nulls first, d) - 1 as pos from docs),
a0 as (select tree, pos, d from p),
p0 as (select doc_id, d as leaf, null::varchar as subroot, tree, pos, f, '' as proof from p),
{",".join(_level_sql("a", "p", i) for i in range(levels))},
b as (select tree as name, row_number() over (order by tree) - 1 as pos, d from a{levels}),
b0 as (select '' as tree, pos, d from b),
q0 as (select doc_id, leaf, d as subroot, '' as tree, b.pos, f, proof from p{levels} x join b on name = x.tree),
{",".join(_level_sql("b", "q", i) for i in range(upper))}
select doc_id, leaf, subroot, d as root, sha256(proof) as proof_sha256, f as folded_root, f = d as verified
from q{upper} join b{upper} using (tree)"""


@query("op13_manifest", manifest_sql())
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


@query("op11_lm_score")
def op11_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")
