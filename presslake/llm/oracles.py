"""SQL for the training-data queries that SQL can express."""

ORACLES = {
    "op6_exact_dedup": """
        with n as (
            select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') as body
            from documents)
        select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
            doc_id = max(doc_id) over w as kept, sha256(body) as text_sha256
        from n window w as (partition by body)
    """,
    "op7_decontaminate": r"""
        with d as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
            from documents),
        b as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws
            from benchmark),
        p as (
            select distinct item_id, least(len(ws), 10) as k, array_to_string(ws[s + 1 : s + least(len(ws), 10)], ' ') as phrase
            from (select item_id, ws, unnest(range(0, greatest(len(ws) - 10, 0) + 1)) as s from b where len(ws) > 0)),
        w as (
            select doc_id, k, s, array_to_string(ws[s + 1 : s + k], ' ') as phrase
            from (select doc_id, ws, k, unnest(range(0, len(ws) - k + 1)) as s
                from d, (select distinct k from p) where len(ws) >= k)),
        m as (select w.doc_id, w.k, w.s, p.item_id from w join p on w.k = p.k and w.phrase = p.phrase),
        h as (
            select doc_id, count(distinct place) as n_hit
            from (select doc_id, unnest(range(s, s + k)) as place from m) group by doc_id),
        i as (
            select doc_id, count(*) as n_items, sha256(string_agg(item, ',' order by item)) as items
            from (select distinct doc_id, item_id::varchar as item from m) group by doc_id)
        select d.doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
            coalesce(items, sha256('')) as items_sha256, n_hit is not null as contaminated
        from d left join h using (doc_id) left join i using (doc_id)
    """,
}
