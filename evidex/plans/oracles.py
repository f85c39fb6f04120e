"""The registered queries written again as SQL over the given tables, to check the results against."""

from __future__ import annotations

from evidex.operators.kpi import BACKTEST_SPLITS, HORIZON_DAYS
from evidex.plans.inputs import TABLE_NAMES

Z = "1.959963984540054"

# Shared parts

LABEL_QUERIES = """
places as (select label, unnest(embedding) as x, generate_subscripts(embedding, 1) as place from embeddings),
means as (select label, place, avg(x::double) as x from places group by label, place),
queries as (select 'label_' || label as query_id, list(x order by place) as v from means group by label),
base as (select vec_id as item_id, label, embedding::double[] as v from embeddings)
"""


NAMES = """names as (select lower(p_name) as name from part
    union select regexp_extract(lower(text), '^[a-z0-9]+ [a-z0-9]+') from documents where regexp_matches(lower(text), '^[a-z0-9]+ [a-z0-9]+'))"""

# Names of letters, digits and single blanks only.
HAS_NAME = "contains({0}, name) and regexp_matches({0}, '(^|[^a-z0-9])' || name || '([^a-z0-9]|$)')"


def label_hits(k: int) -> str:
    return f"""{LABEL_QUERIES},
scored as (select query_id, item_id, label, round(1 - list_cosine_similarity(base.v, queries.v), 9) as distance
           from base, queries),
ranked as (select *, row_number() over (partition by query_id order by distance, item_id) as rank from scored),
hits as (select * from ranked where rank <= {k})
"""


PROBED = f"""{label_hits(40)},
centers as (select query_id as center, v from queries),
assigned as (select item_id, center from (select item_id, center, row_number() over (partition by item_id
    order by round(1 - list_cosine_similarity(base.v, centers.v), 9), center) as n from base, centers) where n = 1),
probes as (select query_id, center from (select q.query_id, c.center, row_number() over (partition by q.query_id
    order by round(1 - list_cosine_similarity(q.v, c.v), 9), c.center) as n from queries q, centers c) where n <= 8),
probed as (select query_id, item_id, distance from scored join assigned using (item_id) join probes using (query_id, center)),
probed_hits as (select * from (select *, row_number() over (partition by query_id order by distance, item_id) as rank from probed)
                where rank <= 40)
"""

CELL_BOUNDS = f"""{PROBED},
angles as (select item_id, p.center as pole, acos(greatest(-1, least(1, list_cosine_similarity(base.v, p.v)))) as angle from base, centers p),
ranges as (select center, pole, min(angle) as low, max(angle) as high, count(*) as n_rows
           from angles join assigned using (item_id) group by center, pole),
seen as (select q.query_id, p.center as pole, acos(greatest(-1, least(1, list_cosine_similarity(q.v, p.v)))) as angle from queries q, centers p),
gaps as (select query_id, center, max(n_rows) as n_rows, greatest(0, max(low - angle), max(angle - high)) as gap
         from seen join ranges using (pole) group by query_id, center),
last as (select query_id, max(distance) as kth from hits group by query_id),
numbered as (select center, (row_number() over (order by center) - 1)::int as cell from centers)
"""

DOC_CHUNKS = """
doc_chunks as (select sha256('doc://' || source || '/' || doc_id || '#pdf') as chunk_id,
                      'doc://' || source || '/' || doc_id as source_uri, text, lang
               from documents where length(text) > 0)
"""

TOKENS = r"regexp_extract_all(lower({0}), '[\p{{L}}\p{{N}}]+')"


def embedded(name: str, source: str, key: str, text: str, dim: int = 768) -> str:
    """Non-zero places of the hashed embedding in long form."""
    return f"""
{name}_words as (select {key}, unnest({TOKENS.format(text)}) as word from {source}),
{name}_counts as (select {key}, (('0x' || substr(md5(word), 1, 8))::bigint % {dim})::int as bucket, count(*)::double as c
                  from {name}_words group by all),
{name}_norms as (select {key}, sqrt(sum(c * c)) as norm from {name}_counts group by {key}),
{name} as (select {key}, bucket, c / norm as weight from {name}_counts join {name}_norms using ({key}))
"""


DOC_VECTORS = DOC_CHUNKS + "," + embedded("doc_vec", "doc_chunks", "chunk_id", "text")


def text_hits(queries: str, key: str, k: int) -> str:
    """Ranked chunks per query, both in long form."""
    return f"""
dots as (select q.{key} as query_id, d.chunk_id, sum(q.weight * d.weight) as dot
         from {queries} q join doc_vec d on q.bucket = d.bucket group by all),
pairs as (select q.{key} as query_id, d.chunk_id
          from (select distinct {key} from {queries}) q, (select distinct chunk_id from doc_vec) d),
scored as (select query_id, chunk_id, round(1 - coalesce(dot, 0), 9) as distance
           from pairs left join dots using (query_id, chunk_id)),
ranked as (select *, row_number() over (partition by query_id order by distance, chunk_id) as rank from scored),
hits as (select * from ranked where rank <= {k})
"""


QUESTIONS = "questions as (select 'b' || item_id as query_id, text as query from benchmark)"
CONTEXT = f"""{DOC_VECTORS}, {QUESTIONS}, {embedded("question_vec", "questions", "query_id", "query")},
{text_hits("question_vec", "query_id", 12)},
context as (select query_id, source_uri, text, distance, rank from hits join doc_chunks using (chunk_id))
"""
HOLDOUT = f"""{DOC_VECTORS},
first_chunks as (select chunk_id, text from doc_chunks order by chunk_id limit 200),
holdout as (select 'hq_' || row_number() over (order by chunk_id) as query_id, text as query_text, chunk_id as item_id
            from first_chunks)
"""

TITLE = "nullif(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '')"
CAPTIONS = f"""captions as (select sha256(url) as image_id, url as source_uri, {TITLE} as caption, page_id from pages)"""
PAGE_TEXT = (
    "trim(regexp_replace(regexp_replace(regexp_replace(html, "
    "'(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '[ \\t\\r\\n]+', ' ', 'g'))"
)
PAGE_CHUNKS = f"""page_texts as (select url as source_uri, {PAGE_TEXT} as text from pages),
page_chunks as (select sha256(source_uri || '#screen') as chunk_id, source_uri, text from page_texts where length(text) > 0)
"""
SPAN = "0::bigint as offset_start, length(text)::bigint as offset_end"

METRICS = """
per_query as (select truth.query_id, count(*) as truth_n, count(rank) as hits, min(rank) as best
              from truth left join preds using (query_id, item_id) group by truth.query_id),
metrics as (select query_id, 40::bigint as k, hits::double / truth_n as recall_k, hits / 40.0::double as precision_k,
                   coalesce(1.0::double / best, 0.0) as mrr from per_query)
"""
METRIC_COLUMNS = "round(recall_k, 9) as recall_k, round(precision_k, 9) as precision_k, round(mrr, 9) as mrr"
LABEL_METRICS = f"""{label_hits(40)},
preds as (select query_id, item_id, rank from hits),
truth as (select 'label_' || label as query_id, vec_id as item_id from embeddings), {METRICS}
"""

EDGE = """sha256(query_id || '|' || item_id || '|text|text') as edge_id, query_id as left_id, item_id::varchar as right_id"""
HYBRID = f"""{label_hits(40)},
edges as (select {EDGE}, 1.0 - distance as similarity,
          round(0.6::double * (1.0 - distance) + 0.2::double * 1 + 0.1::double * 0 + 0.1::double * 0, 9) as hybrid_score from hits)
"""


def sample_position(key: str) -> str:
    return f"((('0x' || substr(sha256({key}::varchar || '42'), 1, 8))::bigint % 1000000) / 1000000.0::double)"


# Facts

FACT = """
select sha256(chunk_id || '#fact') as fact_id, entity as subject,
       case when value is not null then 'has_value' when day is not null then 'has_date' else 'mentioned' end as predicate,
       coalesce(value, day) as object_value, try_cast(value as double) as object_number, try_cast(day as date) as object_date,
       source_uri, length(text)::bigint as offset_end,
       (case when entity is not null then 5 else 0 end + case when value is not null then 3 else 0 end
        + case when day is not null then 2 else 0 end) / 10.0::double as confidence
from {0}
"""
NUMBER = r"-?[0-9]+(?:\.[0-9]+)?"
DAY = "nullif(regexp_extract(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}'), '')"
DOC_FACTS = rf"""{DOC_CHUNKS},
doc_found as (select *, nullif(regexp_extract(text, '\p{{Lu}}[\p{{L}}\p{{N}}]*'), '') as entity,
                     nullif(regexp_extract(text, '{NUMBER}'), '') as value, {DAY} as day from doc_chunks),
doc_facts as (select * from ({FACT.format("doc_found")}) where confidence >= 0.65 and subject is not null)
"""
ORDER_FACTS = rf"""
order_texts as (select 'order://' || o_orderkey as source_uri,
    'Customer ' || o_custkey || ' placed order ' || o_orderkey || ' totalling ' || o_totalprice::decimal(18,2)
    || ' on ' || o_orderdate::date || ' with status ' || o_orderstatus || '.' as text from orders),
order_chunks as (select sha256(source_uri || '#pdf') as chunk_id, * from order_texts),
order_found as (select *, nullif(regexp_extract(text, 'Customer [0-9]+'), '') as entity,
                       nullif(regexp_extract(text, 'totalling ({NUMBER})', 1), '') as value, {DAY} as day from order_chunks),
order_facts as (select * from ({FACT.format("order_found")}) where confidence >= 0.65 and subject is not null)
"""
ALL_FACTS = f"{DOC_FACTS}, {ORDER_FACTS}, facts as (select * from doc_facts union all select * from order_facts)"

# Validators

QUALITY = f"""
quality_results as (select doc_id::varchar as item_id, 'rule_quality' as rule_id, quality = 1 as result_bool,
    null::double as score, null::varchar as note from labels where toxic <> 1 and {sample_position("doc_id")} < 0.25)
"""
VALUE = """
value_ranked as (select *, row_number() over (partition by user_id
    order by sha256(user_id::varchar || '|' || event_id || '|42'), event_id) as n from events),
value_results as (select user_id::varchar as item_id, 'rule_value' as rule_id, value > 10 as result_bool,
    null::double as score, null::varchar as note from value_ranked where n <= 5)
"""
TOTAL = f"""
lines as (select l_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 2) as line_total from lineitem group by l_orderkey),
total_results as (select o_orderkey::varchar as item_id, 'rule_total' as rule_id,
    abs(o_totalprice::decimal(18,2)::double - line_total) <= 0.5::double * abs(line_total) as result_bool,
    o_totalprice::decimal(18,2)::double as score, 'tolerance=0.5' as note
    from orders join lines on o_orderkey = l_orderkey where {sample_position("o_orderkey")} < 0.25)
"""
BRAND = """
brand_results as (select p_partkey::varchar as item_id, 'rule_brand_model' as rule_id,
    regexp_matches(lower(p_name), '(^|[^a-z0-9])(widget|bolt)([^a-z0-9]|$)') as result_bool,
    null::double as score, null::varchar as note from part)
"""
TABLE_TEXT = f"""{ALL_FACTS},
table_text_checked as (select *, try_cast(nullif(regexp_extract(object_value, '{NUMBER}'), '') as double) as found from facts),
table_text_results as (select fact_id as item_id, 'rule_table_text_total' as rule_id,
    abs(found - object_number) <= 0.02::double * abs(object_number) as result_bool, found as score,
    'tolerance=0.02' as note from table_text_checked)
"""
ALL_RESULTS = f"""{QUALITY}, {VALUE}, {TOTAL}, {BRAND}, {TABLE_TEXT},
results as (select * from quality_results union all select * from value_results union all select * from total_results
            union all select * from brand_results union all select * from table_text_results)
"""

# Answers

VARIANT = "case when ('0x' || substr(sha256(query), 1, 8))::bigint % 1000 < 500 then 'answer_v1' else 'answer_v2' end"
ANSWERS = f"""{CONTEXT},
flat_texts as (select query_id, rank, source_uri, regexp_replace(text, '[\\n\\r]', ' ', 'g') as flat from context),
pieces as (select *, unnest(range(0, (greatest(length(flat), 1) - 1) // 240 + 1)) as place from flat_texts),
snips as (select query_id, rank, source_uri, place, substr(flat, place * 240 + 1, 240) as snippet from pieces),
words as (select query_id, query, list_distinct({TOKENS.format("query")}) as words from questions),
shares as (select w.query_id, s.rank, s.source_uri, s.snippet,
                    len(list_intersect(w.words, {TOKENS.format("s.snippet")})) as shared
             from words w join snips s using (query_id)
             qualify row_number() over (partition by query_id, rank order by shared desc, place) = 1),
tops as (select query_id, max(shared) as best from shares group by query_id),
cited as (select query_id, list(source_uri order by rank, source_uri) as citations,
                 (list(snippet order by rank, source_uri))[1] as summary
          from shares join tops using (query_id) where shared = best and best > 0 group by query_id),
answers as (select sha256(query_id || '|' || {VARIANT} || '|' || query) as answer_id, query_id, query,
                   {VARIANT} as prompt_version, coalesce(summary, '') as summary, coalesce(citations, []) as citations,
                   case when best > 0 then best::double / len(words) when best is not null then 0.0 end as confidence
            from words left join tops using (query_id) left join cited using (query_id))
"""

# KPIs

SERIES = """
series as (select 'orders:' || o_orderpriority as kpi_id, o_orderdate::date as ts, count(*)::double as value from orders
           group by all
           union all
           select 'events:' || event_type as kpi_id, ts::date as ts, count(*)::double as value from events
           group by all),
points as (select kpi_id, ts, value, (ts - date '2000-01-01')::double as x from series)
"""


def fitted(source: str, keys: str) -> str:
    return f"""
sums as (select {keys}, count(*) as n, max(ts) as last_ts, avg(x) as mean_x, avg(value) as mean_y, regr_sxx(value, x) as sxx,
                regr_sxy(value, x) as sxy, regr_syy(value, x) as syy from {source} group by {keys}),
fit as (select *, sxy / sxx as slope, sqrt(greatest(syy - sxy / sxx * sxy, 0) / (n - 2)) as sigma
        from sums where n >= 3 and sxx > 0),
days as (select *, last_ts + step::int as day from fit, range(1, {HORIZON_DAYS + 1}) r(step)),
offs as (select *, (day - date '2000-01-01')::double - mean_x as off from days),
projected as (select *, mean_y + slope * off as predicted,
                     {Z}::double * sigma * sqrt(1.0 + 1.0::double / n + off * off / sxx) as half from offs)
"""


FORECAST = f"""{SERIES}, {fitted("points", "kpi_id")},
forecasts as (select sha256(kpi_id || '|' || last_ts) as run_id, kpi_id, day as ts, predicted, predicted - half as lower,
                     predicted + half as upper, false as backtest from projected)
"""
# Exponential smoothing day by day; each state of the full series is also that of a backtest which ends there.
SMOOTHED = f"""{SERIES},
firsts as (select kpi_id, min(ts) as first_ts from series group by kpi_id),
first_week as (select kpi_id, value, ((ts - date '2000-01-01') % 7 + 7) % 7 as w from series join firsts using (kpi_id) where ts < first_ts + 7),
levels as (select kpi_id, avg(value) as level, count(*) as n_first from first_week group by kpi_id),
effects as (select kpi_id, list(coalesce(value - level, 0) order by w) as effect
            from (from levels, range(0, 7) r(w)) left join first_week using (kpi_id, w) group by kpi_id),
steps as (select kpi_id, ts, value, ((ts - date '2000-01-01') % 7 + 7) % 7 as w, row_number() over (partition by kpi_id order by ts) as i
          from series join firsts using (kpi_id) where ts >= first_ts + 7),
grid as (select row_number() over (order by weekly, alpha, gamma) as g, *
         from (select unnest([0.02, 0.05, 0.1, 0.2, 0.4])::double as alpha, 0::double as gamma, false as weekly
               union all select alpha, gamma, true from (select unnest([0.02, 0.05, 0.1, 0.2, 0.4])::double as alpha),
                                                        (select unnest([0.05, 0.1, 0.2, 0.4])::double as gamma))),
run as (select kpi_id, g, alpha, gamma, n_first, 0::bigint as i, null::date as ts, level,
               case when weekly then effect else [0, 0, 0, 0, 0, 0, 0]::double[] end as effect, 0::double as squares
        from levels join effects using (kpi_id), grid
        union all
        select kpi_id, g, alpha, gamma, n_first, i, ts, level + alpha * e,
               list_transform(effect, lambda x, n: x + case when n = w + 1 then gamma * e else 0 end), squares + e * e
        from (select r.*  exclude (i, ts), s.i, s.ts, s.w, s.value - (r.level + r.effect[s.w + 1]) as e
              from run r join steps s on r.kpi_id = s.kpi_id and s.i = r.i + 1)),
best as (select * from run where i > 0 and n_first + i >= 14 qualify row_number() over (partition by kpi_id, i order by squares, g) = 1),
days as (select *, ts + h::int as day, level + effect[((ts - date '2000-01-01' + h) % 7 + 7) % 7 + 1] as predicted,
                {Z}::double * sqrt(squares / i * (1 + coalesce(list_sum(list_transform(range(1, h),
                    lambda j: (alpha + case when j % 7 = 0 then gamma else 0 end) ** 2)), 0))) as half
         from best, range(1, {HORIZON_DAYS + 1}) r(h)),
newest as (select kpi_id, ts as split_ts, row_number() over (partition by kpi_id order by ts desc) as back from series)
"""


def tested(splits: int) -> str:
    """Backtests of both methods as of each of the last days."""
    return f"""
line_tested as (
    with splits as (select kpi_id, split_ts from newest where back <= {splits}),
    train as (select points.*, split_ts from points join splits on points.kpi_id = splits.kpi_id and ts <= split_ts),
    {fitted("train", "kpi_id, split_ts")}
    select 'line' as method, p.kpi_id, split_ts, day as ts, predicted, predicted - half as lower, predicted + half as upper from projected p),
seasonal_tested as (select 'seasonal' as method, d.kpi_id, split_ts, day as ts, predicted, predicted - half as lower, predicted + half as upper
                    from days d join newest n on n.kpi_id = d.kpi_id and split_ts = d.ts where back <= {splits})
"""


FORECAST_COLUMNS = "round(predicted, 6) as predicted, round(lower, 6) as lower, round(upper, 6) as upper"
INDEX = """
counts as (select 'text_emb_idx' as index_name, (select count(*) from documents) as row_count
           union all select 'image_emb_idx', (select count(*) from pages)
           union all select 'hot_emb_idx', (select count(*) from embeddings where len(embedding) > 0)),
state as (select 'text_emb_idx' as index_name, (select count(*) from labels) as last_row_count
          union all select 'image_emb_idx', (select count(*) from pages)),
growth as (select index_name, row_count, last_row_count,
                  100.0::double * (row_count - coalesce(last_row_count, 0)) / greatest(coalesce(last_row_count, 0), 1) as growth_pct
           from counts left join state using (index_name)),
decisions as (select *, case when row_count < 1 then 'SKIP' when last_row_count is null then 'CREATE'
                             when growth_pct > 15 then 'REBUILD' else 'KEEP' end as decision from growth)
"""

RUN_COUNTS = rf"""{DOC_CHUNKS}, {PAGE_CHUNKS}, {CAPTIONS},
turns as (select 'conv://' || conv_id || '/' || turn as source_uri, text from conversations),
all_chunks as (
    select chunk_id, text from doc_chunks union all select chunk_id, text from page_chunks
    union all select sha256(source_uri || '#img'), text from turns where length(text) > 0
    union all select sha256(source_uri || '#cap'), caption from captions where length(caption) > 0),
chunks as (select distinct on (chunk_id) chunk_id, text from all_chunks),
with_tokens as (select chunk_id from chunks where regexp_matches(text, '[\p{{L}}\p{{N}}]')),
found as (select chunk_id, nullif(regexp_extract(text, '\p{{Lu}}[\p{{L}}\p{{N}}]*'), '') as entity,
                 nullif(regexp_extract(text, '{NUMBER}'), '') as value, {DAY} as day from chunks),
facts as (select sha256(chunk_id || '#fact') as fact_id, try_cast(day as date) as object_date from found
          where entity is not null and (value is not null or day is not null)),
sampled_images as (select image_id from captions where {sample_position("image_id")} < 0.25),
sampled_facts as (select fact_id from facts where {sample_position("fact_id")} < 0.25),
daily as (select o_orderdate::date as ts from orders
          where o_orderdate::date >= (select max(o_orderdate)::date - 180 from orders) group by all),
fact_days as (select distinct coalesce(object_date, (select max(o_orderdate)::date from orders)) as ts from facts),
series as (select 'orders' as kpi_id, ts from daily union all select 'demo_kpi', ts from fact_days),
fits as (select kpi_id, count(*) as n from series group by kpi_id union all
         select s.kpi_id, count(*) from series s join (select kpi_id, ts as split_ts from series
             qualify row_number() over (partition by kpi_id order by ts desc) <= {BACKTEST_SPLITS}) p
             on s.kpi_id = p.kpi_id and s.ts <= p.split_ts group by s.kpi_id, split_ts),
sizes as (select (select count(*) from chunks) as chunks, (select count(*) from with_tokens) as vectors,
                 (select least(200, count(*)) from chunks) as hot, (select count(*) from facts) as facts,
                 (select count(*) from captions) as images, (select count(*) from sampled_images) as s_images,
                 (select count(*) from sampled_facts) as s_facts, (select count(*) from benchmark) as questions)
"""
RUN_TABLES = {
    "objects_images": "0", "objects_pdfs": "0", "objects_screens": "0", "text_chunks": "chunks", "image_desc": "images",
    "text_emb": "vectors",
    "image_emb": r"(select count(*) from captions where regexp_matches(caption, '[\p{L}\p{N}]'))",
    "facts_generic": "facts", "edges_semantic": "hot * 40", "answers": "questions",
    "event_days": "0", "kpi_sketch": "(select count(*) from (select kpi_id from series group by kpi_id having count(*) >= 3))", "kpi_series": "(select count(*) from series)",
    "kpi_forecast": f"(select count(*) * {HORIZON_DAYS} from fits where n >= 3)",
    "metrics_validators": "s_images + s_facts + images + facts", "metrics_retrieval": "hot",
    "prompt_log": "chunks + s_images + s_facts + questions", "metrics_index_state": "2", "hot_queries": "hot",
    "precomputed_neighbors": "hot * 64", "retrieval_gt": "hot",
}

HIT_COLUMNS = "query_id, item_id, distance, rank::int as rank"
FACT_COLUMNS = "fact_id, subject, predicate, object_value, object_number, object_date, source_uri, offset_end, confidence"
CONVERSATION_CHUNKS = f"""
with turns as (select 'conv://' || conv_id || '/' || turn as source_uri, text from conversations)
select sha256(source_uri || '#img') as chunk_id, source_uri, text, null::varchar as lang, {SPAN} from turns where length(text) > 0
"""

ORACLES: dict[str, str] = {
    "vector_topk": f"with {label_hits(40)} select {HIT_COLUMNS} from hits",
    "vector_topk_constrained": f"with {label_hits(40)} select {HIT_COLUMNS} from hits where distance <= 0.9 and label in (1, 3, 5, 7)",
    "precomputed_neighbors": f"""with {label_hits(64)}
        select query_id, item_id::varchar as neighbor_id, 'text' as neighbor_type, round(1.0 - distance, 6) as similarity from hits""",
    "semantic_edges": f"""with {label_hits(40)}
        select {EDGE}, 'text' as left_type, 'text' as right_type, round(1.0 - distance, 6) as similarity,
               true as constraints_ok, null::varchar as constraint_notes from hits""",
    "hybrid_top": f"""with {HYBRID} select left_id, right_id, round(similarity, 6) as similarity, round(hybrid_score, 6) as hybrid_score
        from (select * from edges order by edges.hybrid_score desc, edge_id limit 100)""",
    "hybrid_preview": f"""with {HYBRID} select left_id, right_id, round(hybrid_score, 6) as hybrid_score, 0.0::double as recency_score,
        0.0::double as validator_pass_rate from (select * from edges order by edges.hybrid_score desc, edge_id limit 10)""",
    "retrieval_metrics": f"with {LABEL_METRICS} select query_id, k, {METRIC_COLUMNS} from metrics",
    "retrieval_metrics_mean": f"""with {LABEL_METRICS} select k, round(avg(metrics.recall_k), 9) as recall_k,
        round(avg(metrics.precision_k), 9) as precision_k, round(avg(metrics.mrr), 9) as mrr from metrics group by k""",
    "holdout": f"""with {HOLDOUT} select query_id, item_id, length(query_text)::int as query_chars,
        case when item_id in (select chunk_id from doc_vec) then 768 end as vector_dim from holdout""",
    "retrieval_metrics_holdout": f"""with {HOLDOUT},
        hold_vec as (select query_id, bucket, weight from holdout join doc_vec on item_id = chunk_id),
        {text_hits("hold_vec", "query_id", 40)},
        preds as (select query_id, chunk_id as item_id, rank from hits), truth as (select query_id, item_id from holdout), {METRICS}
        select query_id, k, {METRIC_COLUMNS} from metrics""",
    "context_topk": f"with {CONTEXT} select query_id, source_uri, text, round(distance, 6) as distance, rank::int as rank from context",
    "context_with_fallback": f"""with {CONTEXT}, {CAPTIONS},
        near as (select query_id, source_uri, text, row_number() over (partition by query_id order by rank, source_uri) as rank
                 from context where distance <= 0.4),
        held as (select q.query_id, count(rank) as held from questions q left join near using (query_id) group by q.query_id),
        recent as (select source_uri, caption as text, row_number() over (order by page_id desc, source_uri) as place
                   from captions where caption is not null qualify place <= 12)
        select query_id, source_uri, text, rank::int as rank, true as is_primary from near
        union all
        select query_id, source_uri, text, (held + place)::int as rank, false as is_primary
        from held, recent where held + place <= 12""",
    "image_topk": f"""with {CAPTIONS}, {QUESTIONS}, {embedded("img_vec", "captions", "image_id", "caption", 1024)},
        {embedded("question_vec", "questions", "query_id", "query", 1024)},
        dots as (select q.query_id, i.image_id, sum(q.weight * i.weight) as dot
                 from question_vec q join img_vec i on q.bucket = i.bucket group by all),
        pairs as (select query_id, image_id from (select distinct query_id from question_vec), (select distinct image_id from img_vec)),
        scored as (select query_id, image_id, round(1 - coalesce(dot, 0), 9) as distance from pairs left join dots using (query_id, image_id)),
        ranked as (select *, row_number() over (partition by query_id order by distance, image_id) as rank from scored)
        select query_id, image_id as item_id, round(distance, 6) as distance, rank::int as rank from ranked where rank <= 12""",
    "neighbors_of_all": """with v as (select vec_id, embedding::double[] as v from embeddings),
        scored as (select q.vec_id as query_id, b.vec_id as item_id, round(1 - list_cosine_similarity(b.v, q.v), 9) as distance from v q, v b),
        ranked as (select *, row_number() over (partition by query_id order by distance, item_id) as rank from scored)
        select query_id, item_id, distance, rank::int as rank from ranked where rank <= 5""",
    "ivf_full_probe": f"with {label_hits(40)} select {HIT_COLUMNS} from hits",
    "ivf_topk": f"with {PROBED} select {HIT_COLUMNS} from probed_hits",
    "ivf_recall": f"""with {PROBED} select query_id, avg((p.item_id is not null)::int::double) as recall
        from hits left join probed_hits p using (query_id, item_id) group by query_id""",
    "ivf_exact": f"with {label_hits(40)} select {HIT_COLUMNS} from hits",
    "ivf_cell_bounds": f"""with {CELL_BOUNDS} select query_id, cell, n_rows, round(1 - cos(gap), 6) as bound, 1 - cos(gap) <= kth as may_hold
        from gaps join last using (query_id) join numbered using (center)""",
    "list_objects": """select 'documents' as name, count(*) as n_chunks, sum(length(text))::bigint as n_chars from documents where length(text) > 0
        union all select 'conversations', count(*), sum(length(text))::bigint from conversations where length(text) > 0""",
    "index_decision": f"""with {INDEX} select index_name, row_count, last_row_count, round(growth_pct, 6) as growth_pct, decision
        from decisions""",
    "index_state": f"""with {INDEX} select index_name, case when decision in ('CREATE', 'REBUILD') then row_count else last_row_count end
        as last_row_count from decisions""",
    "index_health": f"""with {INDEX} select index_name as table_name, row_count, last_row_count is not null as has_index from decisions""",
    "object_chunks": f"""select page_id, text, length(text)::bigint as offset_end
        from (select page_id, {PAGE_TEXT} as text from pages) where length(text) > 0""",
    "object_catalog": "select url as object_uri from pages union select 'doc://' || source || '/' || doc_id from documents",
    "table_counts": " union all ".join(f"select '{t}' as table_name, count(*) as n from {t}" for t in TABLE_NAMES),
    "pending_documents": "select doc_id from documents where doc_id not in (select doc_id from labels)",
    "insert_if_absent": """select doc_id, quality::varchar as quality from labels
        union all select doc_id, 'unknown' from documents where doc_id not in (select doc_id from labels)""",
    "upsert_status": """with newest as (select o_custkey, o_orderstatus from orders
            qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1)
        select coalesce(c_custkey, o_custkey) as c_custkey, coalesce(o_orderstatus, 'none') as status
        from customer full join newest on c_custkey = o_custkey""",
    "upsert_edges": f"""with {label_hits(64)} select {EDGE}, round(1.0 - distance, 6) as similarity, rank <= 40 as constraints_ok
        from hits""",
    "purge_expired": """select event_id, event_type, value from events
        where (epoch_us((select max(ts) from events)) - epoch_us(ts)) // 60000000 <= 60""",
    "pending_clustered": "select doc_id, source from documents where doc_id not in (select doc_id from labels where doc_id is not null)",
    "insert_clustered": """select doc_id, quality from labels
        union all select doc_id, -1::int as quality from documents where doc_id not in (select doc_id from labels where doc_id is not null)""",
    "purge_by_day": """select event_id, event_type, value from events
        where (epoch_us((select max(ts) from events)) - epoch_us(ts)) // 60000000 <= 14400""",
    "upsert_by_day": """select event_type as kpi_id, ts::date as ts,
            case when ts::date > (select max(ts)::date from events) - 10 then count(distinct user_id) else count(*) end as value
        from events group by event_type, ts::date""",
    "drop_empty_vectors": f"""with words as (select doc_id, {TOKENS.format("text")} as words from documents)
        select doc_id, len(words)::int as n from words where len(words) > 0""",
    "hash_sample": f"""select doc_id, round({sample_position("doc_id")}, 6) as position from documents
        where {sample_position("doc_id")} < 0.25""",
    "cap_per_key": """select user_id, event_id, rank::int as rank from (select user_id, event_id, row_number() over (
            partition by user_id order by sha256(user_id::varchar || '|' || event_id || '|42'), event_id) as rank from events)
        where rank <= 5""",
    "ab_variant": f"with {QUESTIONS} select query_id, {VARIANT} as prompt_version from questions",
    "snippets": """select doc_id, substr(regexp_replace(text, '[\\n\\r]', ' ', 'g'), 1, 240) as snippet,
        substr(regexp_replace(text, '[\\n\\r"]', ' ', 'g'), 1, 96) as short_snippet from documents""",
    "clamp_confidence": """select event_id, case when event_type <> 'error' then
        round(greatest(0.0, least(1.0, value / 10 - 0.5)), 9) end as confidence from events""",
    "chunks_documents": f"with {DOC_CHUNKS} select chunk_id, source_uri, text, lang, {SPAN} from doc_chunks",
    "chunks_pages": f"with {PAGE_CHUNKS} select chunk_id, source_uri, text, null::varchar as lang, {SPAN} from page_chunks",
    "chunks_conversations": CONVERSATION_CHUNKS,
    "chunks_captions": f"""with {CAPTIONS}, texts as (select source_uri, caption as text from captions where length(caption) > 0)
        select sha256(source_uri || '#cap') as chunk_id, source_uri, text, null::varchar as lang, {SPAN} from texts""",
    "hashed_embedding": f"with {DOC_VECTORS} select chunk_id, bucket, round(weight, 6) as weight from doc_vec",
    "embed_missing_captions": f"""with {CAPTIONS}, {PAGE_CHUNKS},
        todo as (select * from captions where caption is not null
                 and image_id not in (select sha256(source_uri) from page_chunks where length(text) > 2000)),
        {embedded("vec", "todo", "image_id", "caption", 1024)} select image_id, bucket, round(weight, 6) as weight from vec""",
    "facts_documents": f"with {DOC_FACTS} select {FACT_COLUMNS} from doc_facts",
    "facts_orders": f"with {ORDER_FACTS} select {FACT_COLUMNS} from order_facts",
    "prompt_log": """select sha256('facts_v1|facts_v1|' || doc_id) as call_id, 'facts_v1' as prompt_id, 'facts_v1' as prompt_version,
        'rules' as model_id, sha256(text) as input_hash from documents where doc_id not in (select doc_id from labels)""",
    "image_descriptions": f"""with {CAPTIONS} select image_id, source_uri, caption, 0 as n_colors, null::bigint as width_px,
        null::bigint as height_px from captions where caption is not null""",
    "generate_table": """with words as (select doc_id, regexp_extract_all(text, '[^ \\t\\r\\n]+') as words from documents)
        select doc_id, case when len(words) > 0 then len(words) end as n_words, words[1] as first_word from words""",
    "generate_table_sql": """with words as (select doc_id, regexp_extract_all(text, '[^ \\t\\r\\n]+') as words from documents)
        select doc_id, case when len(words) > 0 then len(words) end as n_words, words[1] as first_word from words""",
    "transcripts_sql": """with t as (select *, lag(role) over (partition by conv_id order by turn) as before, row_number() over (partition by conv_id order by turn) as n
        from conversations)
        select conv_id, count(*) as turns, count(*) filter (n > 1 and role is distinct from before) as changes, sum(length(coalesce(text, '')))::bigint as chars,
               first(role order by turn) as first_role, last(role order by turn) as last_role from t group by conv_id""",
    "generate_bool": "select doc_id, length(text) > 1000 as result from documents where text is not null",
    "generate_double": """select doc_id, case when text <> '' then len(string_split(text, ' ')) / 8.0::double end as result
        from documents where text is not null""",
    "context_texts": f"""with {CONTEXT}, snips as (select query_id, source_uri, rank,
            substr(regexp_replace(text, '[\\n\\r]', ' ', 'g'), 1, 240) as snippet from context),
        texts as (select query_id, string_agg(snippet, chr(10) || '- ' order by rank, source_uri) as context_text,
                  'Allowed sources: ' || array_to_string(list_sort(list_distinct(list(source_uri))), ', ') as allowed_sources
                  from snips group by query_id)
        select query_id, context_text, allowed_sources from questions left join texts using (query_id)""",
    "validator_color": """select sha256(url) as item_id, 'rule_color_match' as rule_id,
        regexp_matches(lower(caption), '(^|[^a-z0-9])(the|der|la)([^a-z0-9]|$)') as result_bool, null::double as score, null::varchar as note
        from (select url, nullif(regexp_extract(html, '(?is)<title>(.*?)</title>', 1), '') as caption from pages) where caption is not null""",
    "validator_quality": f"with {QUALITY} select * from quality_results",
    "validator_bool": f"with {VALUE} select * from value_results",
    "validator_tolerance": f"with {TOTAL} select * from total_results",
    "validator_brand": f"with {BRAND} select * from brand_results",
    "name_mentions": f"""with {NAMES}, texts as (select doc_id, lower(text) as t from documents)
        select doc_id, name from texts, names where {HAS_NAME.format("t")} group by doc_id, name""",
    "validator_names": f"""with {NAMES}, texts as (select conv_id, turn, text, lower(text) as t from conversations),
        found as (select distinct conv_id, turn from texts, names where {HAS_NAME.format("t")})
        select conv_id || '/' || turn as item_id, 'rule_names' as rule_id,
            case when text is not null then f.conv_id is not null end as result_bool, null::double as score, null::varchar as note
        from texts left join found f using (conv_id, turn)""",
    "validator_table_text": f"with {TABLE_TEXT} select * from table_text_results",
    "validator_coverage": f"""with {ALL_RESULTS} select rule_id, count(*) as n, round(avg(result_bool::int), 9) as pass_rate
        from results group by rule_id""",
    "validator_rollup": f"""with {ALL_RESULTS} select rule_id as name, bool_and(result_bool) as result, min(note) as note
        from results group by rule_id""",
    "answers_extractive": f"""with {ANSWERS}, {QUALITY}, {BRAND},
        results as (select * from quality_results union all select * from brand_results),
        outcomes as (select rule_id, bool_and(result_bool) as result from results group by rule_id)
        select answer_id, query_id, prompt_version, summary, array_to_string(citations, ', ') as cites,
               (select string_agg(rule_id || '=' || result, ', ' order by rule_id) from outcomes) as rules,
               round(confidence, 9) as confidence from answers""",
    "answer_rules": f"""with {ANSWERS}, {QUALITY}, {BRAND},
        results as (select * from quality_results union all select * from brand_results),
        outcomes as (select rule_id, bool_and(result_bool) as result from results group by rule_id)
        select answer_id, (select '[' || string_agg('{{"name":"' || rule_id || '"' || coalesce(',"result":' || result, '') || '}}', ',' order by rule_id) || ']'
                           from outcomes) as validators_summary,
               (select count(*)::int from outcomes) as n_rules,
               coalesce((select string_agg(rule_id, ', ' order by rule_id) from outcomes where not result), '') as failed from answers""",
    "answer_cards": f"""with {ANSWERS} select answer_id, query, summary, len(citations)::int as num_citations,
        round(confidence, 9) as confidence from answers""",
    "latest_answer": f"""with {ANSWERS} select query, summary, array_to_string(citations, ', ') as cites, len(citations)::int as n_citations,
        round(confidence, 3) as confidence from answers order by substr(query_id, 2)::bigint desc, answer_id limit 1""",
    "kpi_daily_counts": """select 'orders' as kpi_id, o_orderdate::date as ts, count(*)::double as value from orders
        where o_orderdate::date >= (select max(o_orderdate)::date - 180 from orders) group by all""",
    "kpi_from_facts": f"""with {ALL_FACTS} select 'demo_kpi' as kpi_id,
        coalesce(object_date, (select max(o_orderdate)::date from orders)) as ts,
        coalesce(sum(object_number::varchar::decimal(28,10))::varchar::double, 0.0) as value from facts group by all""",
    "forecast": f"with {FORECAST} select run_id, kpi_id, ts, {FORECAST_COLUMNS}, backtest from forecasts",
    "forecast_backtest": f"""with {SERIES},
        splits as (select kpi_id, ts as split_ts from series
                   qualify row_number() over (partition by kpi_id order by ts desc) <= {BACKTEST_SPLITS}),
        train as (select points.*, split_ts from points join splits on points.kpi_id = splits.kpi_id and ts <= split_ts),
        {fitted("train", "kpi_id, split_ts")}
        select sha256(p.kpi_id || '|' || split_ts || '|backtest') as run_id, p.kpi_id, split_ts, day as ts,
               round(predicted, 6) as predicted, round(predicted - half, 6) as lower, round(predicted + half, 6) as upper,
               true as backtest, s.value as actual
        from projected p left join series s on p.kpi_id = s.kpi_id and p.day = s.ts""",
    "forecast_seasonal": f"""with recursive {SMOOTHED}
        select sha256(kpi_id || '|' || split_ts || '|seasonal') as run_id, kpi_id, day as ts, round(predicted, 6) as predicted,
               round(predicted - half, 6) as lower, round(predicted + half, 6) as upper, false as backtest
        from days join newest using (kpi_id) where back = 1 and ts = split_ts""",
    "forecast_seasonal_backtest": f"""with recursive {SMOOTHED}, {tested(BACKTEST_SPLITS)}
        select sha256(kpi_id || '|' || split_ts || '|seasonal|backtest') as run_id, kpi_id, split_ts, ts, {FORECAST_COLUMNS},
               true as backtest, value as actual
        from seasonal_tested left join series using (kpi_id, ts)""",
    "forecast_errors": f"""with recursive {SMOOTHED}, {tested(14)}
        select method, kpi_id, count(*) as n, round(avg(abs(value - predicted)), 6) as mae,
               round(avg((value between lower and upper)::int::double), 6) as coverage
        from (from line_tested union all from seasonal_tested) join series using (kpi_id, ts) group by method, kpi_id""",
    "kpi_cards": f"""with {FORECAST} select kpi_id, ts, {FORECAST_COLUMNS}
        from (select * from forecasts order by ts desc, kpi_id limit 100)""",
    "forecast_summary": f"""with {FORECAST} select kpi_id, count(*) as rows_prod, min(ts)::varchar as min_ts, max(ts)::varchar as max_ts,
        round(quantile_cont(predicted, 0.25), 6) as p25, round(quantile_cont(predicted, 0.5), 6) as p50,
        round(quantile_cont(predicted, 0.75), 6) as p75 from forecasts group by kpi_id""",
    "forecast_summary_sketch": f"""with recursive {SMOOTHED}, line_forecasts as (with {fitted("points", "kpi_id")} select kpi_id, day as ts, predicted from projected),
        both_forecasts as (from line_forecasts union all
                           select kpi_id, day as ts, predicted from days join newest using (kpi_id) where back = 1 and ts = split_ts)
        select kpi_id, count(*) as rows_prod, min(ts)::varchar as min_ts, max(ts)::varchar as max_ts,
               round(quantile_disc(predicted, 0.25), 6) as p25, round(quantile_disc(predicted, 0.5), 6) as p50,
               round(quantile_disc(predicted, 0.75), 6) as p75 from both_forecasts group by kpi_id""",
    "order_quantiles": """select o_orderpriority as kpi_id, count(*) as n, min(o_totalprice) as lowest, max(o_totalprice) as highest,
        true as within_error from orders group by all""",
    "event_props": r"""select event_id, try_cast(regexp_extract(props, '"k": (-?[0-9]+)', 1) as bigint) as k,
        nullif(regexp_extract(props, '"k": (-?[0-9]+)', 1), '') as text, null::double as missing, regexp_matches(props, '^\{.*\}$') as is_json from events""",
    "event_props_schema": """select event_type, count(*) as n, count(props) as n_valid, 'OBJECT<k: BIGINT>' as schema from events group by all""",
    "forecast_preview": f"""with {FORECAST} select ts, round(predicted, 6) as predicted from forecasts where kpi_id = 'events:click'
        order by ts limit 48""",
    "stream_daily_counts": """select event_type as kpi_id, ts::date as ts, count(*)::double as value from events
        group by all""",
    "stream_windows": """select event_type as kpi_id, ts::date as ts, count(*)::double as value from events
        group by all""",
    "stream_chunks": CONVERSATION_CHUNKS,
    "stored_run_counts": f"with {RUN_COUNTS} " + " union all ".join(
        f"select '{table}' as table_name, ({n})::bigint as n from sizes" for table, n in RUN_TABLES.items()
    ),
}
