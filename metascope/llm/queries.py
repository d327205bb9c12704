"""One query per operator of this subpackage, over whole tables; and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import jaccard, knn, language, line_dedup, lm, mixing, packing, prefix_trie, quality, rules, substrings, toxicity, whitening
from ..session import tune
from .common import fold, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op3_line_dedup"] = r"""
with lines as (
  select doc_id, pos, line,
    translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
          generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents)),
frequent as (select key from lines where key <> '' group by key having count(distinct doc_id) >= 10)
select doc_id, count(*) as n_lines, count(f.key) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where f.key is null), '')) as kept_sha256
from lines left join frequent f using (key) group by doc_id
"""


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, quality.ratings_of(table(spark, sf_dir, "labels")))
    return quality.grade_quality(docs, model).select("doc_id", "expected_grade", "tail_prob", "kept")


@query
def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "source", "copy", "weight", "place")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, tokenizer_path())


@query
def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fold(F.col("doc_id"), 7)
    scored = lm.score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), part != 2, unknown=None)
    held_out = F.coalesce(part == 2, F.lit(False)).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score", "vocabulary")


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    part = fold(F.col("doc_id"), 3)
    model = language.train(docs, part != 1)
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    part = fold(F.col("doc_id"), 5)
    model = toxicity.train(docs, table(spark, sf_dir, "labels").filter(part != 0))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", F.coalesce(part == 0, F.lit(False)).alias("held_out"), "score", "predicted")


@query
def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.build_trie(table(tune(spark), sf_dir, "conversations"))


ORACLES["op11_prefix_trie"] = r"""
with recursive own as (
  select conv_id as c, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as place,
    coalesce(role, '') as role, coalesce(text, '') as text
  from conversations where conv_id is not null),
-- The checksum by its definition, a byte and then a bit at a time.
sums(c, rest, crc, bits) as (
  select c, cast(c as varchar), cast(4294967295 as bigint), 0 from (select distinct c from own) t
  union all
  select c, case when bits = 0 then substr(rest, 2) else rest end,
    case when bits = 0 then xor(crc, cast(ascii(rest) as bigint)) else xor(crc // 2, 3988292384 * (crc % 2)) end, (bits + 1) % 9
  from sums where bits > 0 or rest <> ''),
convs as (select c, xor(crc, 4294967295) % 4 as h, c - c % 20 as base from sums where rest = '' and bits = 0),
rebuilt as (
  select v.c, o.role, o.text, 0 as part, o.place from convs v join own o on o.c = v.base and o.place <= v.h
  union all select v.c, o.role, o.text, 1, o.place from convs v join own o on o.c = v.c and o.place > v.h),
placed as (select c, role, text, row_number() over (partition by c order by part, place) as depth from rebuilt),
paths(c, depth, node, parent, words) as (
  select c, cast(0 as bigint), md5(''), cast(null as varchar), 0 from convs
  union all
  select p.c, q.depth, md5(p.node || '|' || length(q.role) || '|' || q.role || q.text), p.node, len(regexp_extract_all(q.text, '[^ 	-]+'))
  from paths p join placed q on q.c = p.c and q.depth = p.depth + 1),
ends as (select c, max_by(node, depth) as node from paths group by c),
nodes as (select node, min(depth) as depth, min(parent) as parent, min(c) as conv_id, count(*) as n_convs, min(words) as words from paths group by node),
children as (select parent as node, count(*) as n from nodes where parent is not null group by parent),
-- Each node with each node of its subtree: the smallest member of the lower one passes both.
below as (
  select a.node, sum((n.n_convs - 1) * n.words) as saved_tokens, count(*) filter (where k.n is null) as n_leaves
  from nodes n join paths a on a.c = n.conv_id and a.depth <= n.depth left join children k on k.node = n.node group by a.node),
ids as (select node, string_agg(cast(c as varchar), ',' order by c) as list from ends group by node)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(k.n, 0) as n_children, b.n_leaves,
  cast(b.saved_tokens as bigint) as saved_tokens, sha256(coalesce(i.list, '')) as ends_sha256
from nodes n left join nodes p on p.node = n.parent left join children k on k.node = n.node join below b on b.node = n.node left join ids i on i.node = n.node
"""


@query
def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(table(tune(spark), sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLES["op12_substring_dedup"] = r"""
with texts as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
starts as (select doc_id, w, unnest(range(1, len(w) - 48)) as s from texts where len(w) >= 50),
windows as (select doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) as h from starts),
least as (select h, min(doc_id) as first_id from windows group by h),
hits as (select distinct doc_id, s from windows join least using (h) where first_id < doc_id),
covered as (select distinct doc_id, pos from (select doc_id, unnest(range(s, s + 50)) as pos from hits)),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as pos from texts),
kept as (select doc_id, count(*) as n, string_agg(word, ' ' order by pos) as body
  from words where (doc_id, pos) not in (select doc_id, pos from covered) group by doc_id)
select t.doc_id, len(t.w) as n_words, len(t.w) - coalesce(k.n, 0) as n_removed, sha256(coalesce(k.body, '')) as kept_sha256
from texts t left join kept k on k.doc_id = t.doc_id
"""


@query
def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    rows = white.select("vec_id", "n", "deviation", "explained", "identity_error", F.posexplode("whitened").alias("place", "one"))
    return rows.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        F.col("deviation").cast("long").alias("deviation"),
        F.col("one").alias("whitened"),
        F.col("explained")[F.col("place")].alias("explained"),
        "identity_error",
    )
