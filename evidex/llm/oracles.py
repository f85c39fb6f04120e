"""The same results as SQL, for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce({0}, ''), '[^\x20\x09-\x0D]+')"



def _clusters(k: int, rounds: int, dim: int) -> str:
    """Each round as two tables: the nearest centroid of every vector, and the floors of the means."""
    out = f"""
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v
            from embeddings
            where embedding is not null and len(embedding) = {dim} and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        c0 as (select (row_number() over (order by sha256('2:' || vec_id)) - 1)::integer as cluster, v as c from v order by cluster limit {k})"""
    for r in range(rounds + 1):
        out += f""",
        a{r} as (
            select vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as distance
            from v cross join c{r}
            qualify row_number() over (partition by vec_id order by distance, cluster) = 1
        )"""
        if r < rounds:
            out += f""",
        s{r} as (select cluster, i, sum(x)::bigint as s, count(*) as n from (select cluster, unnest(v) as x, unnest(range(1, {dim} + 1)) as i from a{r}) group by cluster, i),
        m{r} as (select cluster, list((s - ((s % n) + n) % n) // n order by i) as m from s{r} group by cluster),
        c{r + 1} as (select cluster, coalesce(m, c) as c from c{r} left join m{r} using (cluster))"""
    return out + f"""
        select vec_id, cluster, distance, (sum(distance) over (partition by cluster))::bigint as cluster_inertia, (sum(distance) over ())::bigint as inertia,
               sha256(array_to_string(c, ',')) as centroid_sha256
        from a{rounds} join c{rounds} using (cluster)
    """


ORACLES: dict[str, str] = {
    "op11_centroids": _clusters(40, 5, 64),
    "op12_negatives": """
        with v as (
            select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        s as (
            select a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, list_inner_product(a.v, b.v)::bigint as score
            from v a join v b on a.vec_id <> b.vec_id
            where a.vec_id % 100 = 0
        ),
        p as (select anchor_id, id as positive_id, score as positive_score from s where same qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
        n as (
            select p.*, id as negative_id, score as negative_score, row_number() over (partition by p.anchor_id, positive_id order by score desc, id) as n
            from p join s on p.anchor_id = s.anchor_id
            where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
        )
        select anchor_id, positive_id, n::integer as rank, negative_id, positive_score, negative_score from n where n <= 10
    """,
    "op1_minhash": f"""
        with recursive
        w as (select doc_id, {WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} as w from documents),
        s as (select doc_id, list_sort(list_distinct(
                     case when len(w) >= 4 then list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
                          when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as shingles from w),
        sets as (select min(doc_id) as rep, shingles, len(shingles) as n from s where len(shingles) > 0 group by shingles),
        flat as (select rep, n, unnest(shingles) as shingle from sets),
        pairs as (select a.rep as a, b.rep as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as common
                  from flat a join flat b on a.shingle = b.shingle and a.rep < b.rep group by a.rep, b.rep),
        links as (select a, b from pairs where 100 * common >= 80 * (na + nb - common)),
        edges as (select a, b from links union select b, a from links),
        reach as (select rep as node, rep as seen from sets union select edges.b, reach.seen from reach join edges on reach.node = edges.a),
        groups as (select node, min(seen) as component from reach group by node),
        named as (select doc_id, len(s.shingles) as n_shingles, coalesce(component, doc_id) as component_id
                  from s left join sets on s.shingles = sets.shingles left join groups on rep = node)
        select doc_id, n_shingles, component_id, doc_id = component_id as kept from named
    """,
    "op9_substrings": f"""
        with w as (select doc_id, {WORDS.format("text")} as w from documents),
        starts as (select doc_id, w, unnest(range(1, len(w) - 33)) as i from w where len(w) >= 35),
        windows as (select doc_id, i, array_to_string(w[i:i + 34], ' ') as passage from starts),
        twice as (select doc_id, i from windows qualify count(*) over (partition by passage) > 1),
        gone as (select distinct doc_id, unnest(range(i, i + 35)) as p from twice),
        words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from w),
        kept as (select doc_id, string_agg(word, ' ' order by p) as text, count(*) as n from words anti join gone using (doc_id, p) group by doc_id)
        select doc_id, len(w)::bigint as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(kept.text, '')) as kept_sha256
        from w left join kept using (doc_id)
    """,
    "op2_warc": """
        with p as (select page_id, coalesce(html, '') as body from pages),
             d as (select page_id, strlen(body) as payload_bytes, sha256(body) as payload_digest from p),
             f as (select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) else page_id end as first from d)
        select page_id, payload_bytes, payload_digest,
               case when first = page_id then 'response' else 'revisit' end as record_type,
               case when first <> page_id then first end as refers_to
        from f
    """,
    "op4_topk": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v
            from embeddings
            where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ),
        s as (
            select q.vec_id as query_id, b.vec_id, list_inner_product(q.v, b.v)::bigint as score
            from v q join v b on q.vec_id <> b.vec_id
            where q.vec_id % 20 = 0
        ),
        r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as n from s)
        select query_id, n::integer as rank, vec_id, score from r where n <= 20
    """,
    "op7_urls": r"""
        with p as (
            select page_id,
                   coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
                   coalesce(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '') as query
            from pages
        ),
        k as (
            select *, list_sort(list_filter(string_split(query, '&'),
                       lambda x: x <> '' and not regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid|sessionid)(=|$)'))) as kept
            from p
        ),
        c as (
            select *, regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '')
                      || case when len(kept) > 0 then '?' || array_to_string(kept, '&') else '' end as canonical
            from k
        ),
        l as (
            select distinct canonical from c
            where regexp_extract(host, '(?:^|\.)([^.]+)\.[^.]+\.[^.]+$', 1) in ('adult-x', 'ads-track', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm')
        ),
        rules(rule, rule_host, rule_path, verdict) as (values
            ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
            ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')
        ),
        m as (
            select c.*, rules.rule, rules.verdict, row_number() over (partition by page_id, host, path, canonical order by length(rules.rule) desc) as n
            from c left join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
        )
        select page_id, host, path, rule,
               case when rule is not null then verdict when canonical in (select canonical from l) and host <> '' then 'block' else 'allow' end as verdict
        from m where n = 1
    """,
}
