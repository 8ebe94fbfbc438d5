"""SQL for the queries that SQL can express.

The others depend on hashes, tokenizers or trained models that SQL doesn't have; tests compare them
with brute force.
"""

from __future__ import annotations

from cohortry.llm import queries as q

_DOMAIN = """
    case when source = 'src0' then 'web'
         when regexp_matches(source, '[1-5]$') then 'reference'
         else 'news' end
"""


def _poured(level: str, parent: list[str], nodes: str, name: str) -> str:
    """CTEs that share each parent's budget among its children at one level of the mixing tree."""
    by = f"partition by {', '.join(parent)} " if parent else ""
    return f"""
    {level}_order as (
        select *,
            coalesce(sum(supply) over ({by}order by supply / weight, {name}
                rows between unbounded preceding and 1 preceding), 0)::bigint as taken,
            (sum(weight) over ({by}) - coalesce(sum(weight) over ({by}order by supply / weight, {name}
                rows between unbounded preceding and 1 preceding), 0))::bigint as claims
        from ({nodes})
    ),
    {level}_full as (
        select *, supply * claims <= weight * (budget - taken) as is_full from {level}_order
    ),
    {level}_open as (
        select *, max(case when not is_full then claims end) over ({by}) as open_claims,
            min(case when not is_full then taken end) over ({by}) as open_taken
        from {level}_full
    ),
    {level}_quota as (
        select *, (case when is_full then supply
            else (weight * (budget - open_taken)) // open_claims end)::bigint as quota
        from {level}_open
    )"""


def _mixing() -> str:
    plan = q.mixing_plan()
    part, epochs = plan.budget, plan.epochs
    weights = {
        depth: " ".join(
            "when " + " and ".join(f"{c} = '{v}'" for c, v in zip(("domain", "lang", "source"), path, strict=False))
            + f" then {weight}"
            for path, weight in plan.weights.items()
            if len(path) == depth
        )
        for depth in (1, 2)
    }
    return f"""
    with docs as (
        select doc_id, {_DOMAIN} as domain, coalesce(lang, '') as lang, coalesce(source, '') as source,
            len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\r\\n]+'))::bigint as tokens
        from documents
    ),
    {_poured('domains', [], f'''
        select domain, sum(tokens)::bigint * {epochs} as supply,
            (case {weights[1]} else 1 end)::bigint as weight,
            (select sum(tokens)::bigint * {part.numerator} // {part.denominator} from docs) as budget
        from docs group by domain''', 'domain')},
    {_poured('langs', ['domain'], f'''
        select d.domain, d.lang, d.supply, d.weight, a.quota as budget
        from (select domain, lang, sum(tokens)::bigint * {epochs} as supply,
                (case {weights[2]} else 1 end)::bigint as weight
            from docs group by domain, lang) d join domains_quota a using (domain)''', 'lang')},
    {_poured('sources', ['domain', 'lang'], f'''
        select d.domain, d.lang, d.source, d.supply, 1::bigint as weight, a.quota as budget
        from (select domain, lang, source, sum(tokens)::bigint * {epochs} as supply
            from docs group by domain, lang, source) d
            join langs_quota a using (domain, lang)''', 'source')},
    leaves as (
        select domain, lang, source, quota,
            case when supply > 0 then quota // (supply // {epochs}) else {epochs} end as whole,
            quota - (supply // {epochs}) * whole as rest
        from sources_quota
    ),
    drawn as (
        select d.*, whole, rest, sum(d.tokens) over (
            partition by domain, lang, source
            order by md5('{plan.seed}:' || whole || ':' || coalesce(doc_id::varchar, '')), d.tokens, doc_id
            range between unbounded preceding and current row
        ) as upto
        from docs d join leaves using (domain, lang, source)
    )
    select doc_id, domain, lang, source, tokens,
        (whole + case when rest > 0 and upto <= rest then 1 else 0 end)::int as copies
    from drawn where copies > 0
    """


_WARC = """
    with payloads as (
        select page_id, coalesce(html, '') as payload, sha1(payload) as digest from pages
    ),
    largest as (select *, max(page_id) over (partition by digest) as last from payloads)
    select page_id, strlen(payload)::bigint as payload_bytes,
        list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            list_sum(list_transform(range(5), lambda b:
                (substr(unhex(digest)::bit::varchar, (5 * k + b + 1)::int, 1) = '1')::int * (16 >> b::int)
            ))::int + 1, 1)), 'string_agg', '') as payload_digest,
        case when page_id = last then 'response' else 'revisit' end as record_type,
        case when page_id = last then null else last end as refers_to
    from largest
"""

_TOP_K = """
    with whole as (
        select distinct vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v
        from embeddings
        where embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    ),
    scored as (
        select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
        from whole q join whole c on q.vec_id <> c.vec_id
        where q.vec_id % 20 = 0
    )
    select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank,
        vec_id, score
    from scored
    qualify rank <= 20
"""


def _url_filters() -> str:
    rules = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in q.URL_RULES)
    return f"""
    with rules(verdict, host, path) as (values {rules}),
    parsed as (
        select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as tail,
            translate(regexp_extract(tail, '^[^/?#]*'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) as path
        from pages
    ),
    fitting as (
        select p.page_id, p.host, p.path, r.host || r.path as rule, r.verdict,
            row_number() over (
                partition by p.page_id, p.host, p.path
                order by length(r.host || r.path) desc, length(r.host) desc, r.verdict desc
            ) as place
        from (select distinct page_id, host, path from parsed) p join rules r
            on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
    )
    select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') as verdict
    from parsed p left join (select * from fitting where place = 1) f
        on p.page_id is not distinct from f.page_id and p.host = f.host and p.path = f.path
    """


def queries() -> dict[str, str]:
    return {
        "op5_mixing": _mixing(),
        "op6_warc": _WARC,
        "op8_top_k": _TOP_K,
        "op10_url_filters": _url_filters(),
    }
