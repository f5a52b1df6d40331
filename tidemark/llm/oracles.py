"""DuckDB SQL for the training-data queries that SQL can express."""

#: One space for each run of ASCII white space.
_NORM = "regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')"

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op5_exact_dedup": f"""
        with rows as (select doc_id, {_NORM} as norm from documents),
             groups as (select norm, min(doc_id) as keep_id, count(*) as group_size from rows group by norm)
        select r.doc_id, g.keep_id, g.group_size, r.doc_id = g.keep_id as kept, sha256(r.norm) as text_sha256
        from rows r join groups g using (norm)
    """,
    "op10_minhash_near_dedup": f"""
        with recursive words as (select doc_id, regexp_extract_all({_LOWER}, '[^ \\t\\n\\x0B\\f\\r]+') as w from documents),
             sets as (select doc_id, case when len(w) = 0 then [] else
                        list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) end as s from words),
             items as (select doc_id, len(s) as n, unnest(s) as shingle from sets),
             links as (select a.doc_id as a, b.doc_id as b from items a join items b on a.shingle = b.shingle and a.doc_id <> b.doc_id
                       group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
             reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on r.b = l.a)
        select s.doc_id, len(s.s)::bigint as n_shingles, r.component_id, s.doc_id = r.component_id as kept
        from sets s join (select a as doc_id, min(b) as component_id from reach group by a) r using (doc_id)
    """,
    "op8_exact_top_k": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings
                   where vec_id is not null and len(embedding) > 0
                     and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
             scored as (select a.vec_id as query_id, b.vec_id, list_dot_product(a.e, b.e)::bigint as score
                        from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where a.vec_id % 50 = 0),
             ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
        select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
}
