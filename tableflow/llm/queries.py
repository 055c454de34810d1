"""One query for each operator, over its whole table, with SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm import bitpack, bpe, chat, mixing, packing, phrases, quality, relative, \
    simhash, simplex, suffixes, trie, weighted

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(table(spark, sf_dir, "documents"))
    return found.select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                        "n_repeat_words", "base_failed", "kept")


def _quality_sql() -> str:
    rates, shrunk = [], []
    for name in quality.RULES:
        rates.append(f"avg(n_{name} / n_docs) mean_{name}, var_pop(n_{name} / n_docs) var_{name}")
        variance = f"(var_{name} - chance * mean_{name} * (1 - mean_{name}))"
        weight = (f"case when {variance} > {quality.LEAST_VARIANCE} then greatest((1 - chance) * "
                  f"mean_{name} * (1 - mean_{name}) / {variance} - 1, 0.0) else docs_mean end")
        shrunk.append(f"(n_{name} + mean_{name} * ({weight})) / (n_docs + ({weight})) "
                      f"> {quality.HOST_LIMIT}")
    counts = ", ".join(f"sum(case when {rule} then 1.0 else 0.0 end) n_{name}"
                       for name, rule in quality.RULES.items())
    base = " or ".join(f"({quality.RULES[name]})" for name in quality.BASE)
    return rf"""
with d as (select doc_id, source, coalesce(text, '') as text from documents),
w as (select doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(text, chr(10)),
                lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
  from d),
windows as (select doc_id, i, words[i] a, words[i + 1] b, words[i + 2] c
  from (select doc_id, words, unnest(range(1, greatest(len(words) - 1, 1))) i from w)),
twice as (select doc_id, unnest([i, i + 1, i + 2]) i
  from (select doc_id, i, count(*) over (partition by doc_id, a, b, c) n from windows) where n > 1),
repeats as (select doc_id, count(distinct i) n from twice group by doc_id),
m as (select w.doc_id, source, len(words) n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) n_symbols,
    len(lines) n_lines, len(lines) - len(list_distinct(lines)) n_dup_lines,
    coalesce(repeats.n, 0) n_repeat_words
  from w left join repeats on repeats.doc_id = w.doc_id),
hosts as (select source, count(*) n_docs, {counts} from m group by source),
prior as (select avg(n_docs) docs_mean, avg(1.0::double / n_docs) chance, {', '.join(rates)} from hosts),
verdicts as (select source, {' or '.join(f'({x})' for x in shrunk)} host_rejected
  from hosts, prior)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({base}) base_failed, not ({base}) and not host_rejected kept
from m join verdicts on m.source is not distinct from verdicts.source"""


ORACLES["op1_quality_rules"] = _quality_sql()


@query
def op5_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected) are the pair k."""
    turns = table(spark, sf_dir, "conversations")
    pairs = chat.preferences(turns, F.shiftright(turns["conv_id"], 1),
                             F.expr("pmod(conv_id, 2) = 0"))
    return pairs.select(
        "pair_id", "n_common", "prompt", chat.completion_text("chosen").alias("chosen"),
        chat.completion_text("rejected").alias("rejected"),
        chat.completion_mask("chosen").alias("chosen_mask"),
        chat.completion_mask("rejected").alias("rejected_mask"))


ORACLES["op5_preference_pairs"] = r"""
with t as (select conv_id // 2 pair_id, conv_id % 2 side,
    {'turn': turn, 'role': coalesce(role, ''), 'text': coalesce(text, '')} t from conversations),
g as (select pair_id,
    coalesce(list(t order by t.turn nulls first, t.role, t.text) filter (where side = 0), []) a,
    coalesce(list(t order by t.turn nulls first, t.role, t.text) filter (where side = 1), []) b
  from t group by pair_id),
e as (select *, list_transform(range(1, least(len(a), len(b)) + 1),
    lambda i: a[i].role = b[i].role and a[i].text = b[i].text) same from g),
n as (select *, case when list_contains(same, false) then list_position(same, false) - 1
                else least(len(a), len(b)) end n_common from e)
select pair_id, n_common,
  list_aggregate(list_transform(a[1:n_common],
    lambda x: '<|' || x.role || '|>' || chr(10) || x.text || chr(10)) || [''], 'string_agg', '') prompt,
  case when len(a) > 0 then list_aggregate(list_transform(a[n_common + 1:],
    lambda x: '<|' || x.role || '|>' || chr(10) || x.text || chr(10)) || [''], 'string_agg', '') end chosen,
  case when len(b) > 0 then list_aggregate(list_transform(b[n_common + 1:],
    lambda x: '<|' || x.role || '|>' || chr(10) || x.text || chr(10)) || [''], 'string_agg', '') end rejected,
  case when len(a) > 0 then rtrim(list_aggregate(list_transform(a[n_common + 1:],
    lambda x: (length(x.role) + 5) || '- ' || (length(x.text) + 1)
      || case when x.role = 'assistant' then '+' else '-' end || ' ') || [''], 'string_agg', '')) end chosen_mask,
  case when len(b) > 0 then rtrim(list_aggregate(list_transform(b[n_common + 1:],
    lambda x: (length(x.role) + 5) || '- ' || (length(x.text) + 1)
      || case when x.role = 'assistant' then '+' else '-' end || ' ') || [''], 'string_agg', '')) end rejected_mask
from n"""


@query
def op4_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


@query
def op7_packed_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    images = bitpack.write_images(table(spark, sf_dir, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return bitpack.read_images(images)


@query
def op10_sentencepiece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.digests(documents, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                        public_tokenizers.PATTERN)
    return found.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op3_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.without_repeats(table(spark, sf_dir, "documents"))


ORACLES["op3_suffix_array"] = """
with d as (select doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') bytes
  from documents),
b as (select doc_id, unnest(bytes) byte, unnest(range(len(bytes))) i, len(bytes) n from d),
k as (select doc_id, i, string_agg(byte, '') over (partition by doc_id order by i
    rows between current row and 49 following) string, n from b where n >= 50),
m as (select doc_id, i, min(doc_id) over (partition by string) least from k where i <= n - 50),
gone as (select distinct doc_id, unnest(range(i, i + 50)) i from m where least < doc_id),
spans as (select doc_id, count(*) n_spans from (
    select doc_id, i, lag(i) over (partition by doc_id order by i) before from gone)
  where before is null or before < i - 1 group by doc_id),
kept as (select doc_id, count(*) n_kept, string_agg(byte, '' order by i) digits
  from b anti join gone using (doc_id, i) group by doc_id)
select d.doc_id, len(bytes) n_bytes, len(bytes) - coalesce(n_kept, 0) n_removed,
  coalesce(n_spans, 0) n_spans, sha256(unhex(coalesce(kept.digits, ''))) kept_sha256
from d left join kept on kept.doc_id = d.doc_id left join spans on spans.doc_id = d.doc_id"""


@query
def op6_relative_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relative.without_repeats(table(spark, sf_dir, "documents"))


ORACLES["op6_relative_lempel_ziv"] = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') words
  from documents),
w as (select doc_id, unnest(words) word, unnest(range(len(words))) i, len(words) n from d),
k as (select doc_id, i, string_agg(word, ' ') over (partition by doc_id order by i
    rows between current row and 49 following) passage, n from w where n >= 50),
m as (select doc_id, i, min(doc_id) over (partition by passage) least from k where i <= n - 50),
gone as (select distinct doc_id, unnest(range(i, i + 50)) i from m where least < doc_id),
kept as (select doc_id, count(*) n_kept, string_agg(word, ' ' order by i) text
  from w anti join gone using (doc_id, i) group by doc_id)
select d.doc_id, len(words) n_words, len(words) - coalesce(n_kept, 0) n_removed,
  sha256(coalesce(kept.text, '')) kept_sha256
from d left join kept on kept.doc_id = d.doc_id"""


@query
def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexadecimal("fp").alias("fingerprint"), "component_id")


@query
def op8_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted.compared_with_next(table(spark, sf_dir, "documents"))


@query
def op9_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.scored(table(spark, sf_dir, "documents"))


@query
def op11_toivonen_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_toivonen_phrases"] = r"""
with d as (select coalesce(lang, 'und') lang, translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) piece from d),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') words from p),
totals as (select lang, sum(len(words)) n from w group by lang),
g as (select lang, k, list_aggregate(words[i:i + k - 1], 'string_agg', ' ') phrase
  from (select lang, words, unnest(range(1, len(words) + 1)) i from w), range(1, 6) t(k)
  where i + k - 1 <= len(words)),
f as materialized (select lang, k, phrase, count(*) a from g group by all having count(*) >= 100),
c as (select lang, phrase, k, a, string_split(phrase, ' ') words from f where k >= 2),
inner_parts as (select distinct lang, a, list_aggregate(words[i:i + size - 1], 'string_agg', ' ') phrase
  from (select *, unnest(range(1, k + 1)) i from c), range(2, 5) t(size)
  where i + size - 1 <= k and size < k),
cuts as (select lang, phrase, a, cut, list_aggregate(words[:cut], 'string_agg', ' ') first_part,
    list_aggregate(words[cut + 1:], 'string_agg', ' ') rest
  from (select *, unnest(range(1, k)) cut from c)),
scored as (select cuts.lang, cuts.phrase, cuts.a, cut, x.a l, y.a r, n,
    (1000::hugeint * cuts.a * n // (x.a::hugeint * y.a))::bigint score
  from cuts join f x on x.lang = cuts.lang and x.phrase = first_part
  join f y on y.lang = cuts.lang and y.phrase = rest join totals on totals.lang = cuts.lang),
best as (select * from (select *, row_number() over (
    partition by lang, phrase order by score, cut) first_cut from scored) where first_cut = 1),
kept as (select * from best where not exists (select 1 from inner_parts i
  where i.lang = best.lang and i.phrase = best.phrase and i.a >= best.a))
select lang, rank, phrase, a, l, r, n::bigint n, score from (
  select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from kept)
where rank <= 2000"""


@query
def op12_prefix_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = trie.digests(documents, public_tokenizers.path("word_bpe_49k.json"))
    return found.select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op13_simplex_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = simplex.clustered(vectors)
    return found.select("row.vec_id", "cluster", "distance", "cluster_inertia", "inertia",
                        "centroid_sha256")


def _clusters_sql(k: int = 8, rounds: int = 10, size: int = 64) -> str:
    def assigned(number: int) -> str:
        return f"""a{number} as materialized (
  select n, cluster, distance from (
    select n, cluster, distance, row_number() over (partition by n order by distance, cluster) first
    from (select n, cluster, sum((v.x - c.x) * (v.x - c.x))::bigint distance
          from x v join c{number} c using (i) group by n, cluster)) where first = 1)"""

    def moved(number: int) -> str:
        return f"""c{number + 1} as materialized (
  select cluster, i, coalesce((total - (total % members + members) % members) // members, c.x) x
  from c{number} c left join (
    select cluster, i, sum(x)::hugeint total, count(*) members
    from a{number} join x using (n) group by cluster, i) using (cluster, i))"""

    steps = ",\n".join(f"{assigned(r)},\n{moved(r)}" for r in range(rounds))
    return f"""
with v as materialized (
  select row_number() over () n, vec_id, units from (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) units
    from embeddings where len(embedding) = {size}
      and len(list_filter(embedding, lambda x: isfinite(x))) = {size})),
x as materialized (select n, unnest(units) x, unnest(range({size})) i from v),
c0 as materialized (
  select cluster, unnest(units) x, unnest(range({size})) i from (
    select units, row_number() over (order by sha256('3:' || vec_id), units) - 1 cluster from v)
  where cluster < {k}),
{steps},
{assigned(rounds)},
sums as (select cluster, sum(distance)::bigint cluster_inertia from a{rounds} group by cluster),
points as (select cluster, sha256(string_agg(x::bigint::varchar, ',' order by i)) centroid_sha256
  from c{rounds} group by cluster)
select vec_id, cluster::integer as cluster, distance, cluster_inertia,
  (select sum(distance)::bigint from a{rounds}) inertia, centroid_sha256
from v join a{rounds} using (n) join sums using (cluster) join points using (cluster)"""


ORACLES["op13_simplex_clusters"] = _clusters_sql()
