"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

from rankscope.llm import mixing, source_divergence
from rankscope.llm.queries import MIX_SEED, MIX_SHARE, MIX_WEIGHTS


def _level(depth: int) -> str:
    """One level of the budget tree; the level above is ``b<depth>`` with its ``budget``."""
    path = mixing.LEVELS[: depth + 1]
    name = path[-1]
    known = MIX_WEIGHTS.get(name, {})
    cases = " ".join(f"when '{value}' then {weight}" for value, weight in known.items())
    weight = f"case {name} {cases} else 1 end" if known else "1"
    above = ", ".join(path[:-1]) or "1"
    join = f"join b{depth} using ({', '.join(path[:-1])})" if depth else "cross join b0"
    return f"""
n{depth} as (select {", ".join(path)}, room, {weight} as weight, budget
  from (select {", ".join(path)}, sum(room) as room from leaves group by all) {join}),
s{depth} as (select *,
  coalesce(sum(room::hugeint) over (partition by {above} order by room::double / weight, {name}
    rows between unbounded preceding and 1 preceding), 0) as used,
  sum(weight::hugeint) over (partition by {above} order by room::double / weight, {name}
    rows between current row and unbounded following) as weights from n{depth}),
f{depth} as (select *, min((room::hugeint * weights <= (budget - used) * weight)::int)
    over (partition by {above} order by room::double / weight, {name}
    rows between unbounded preceding and current row) as is_full from s{depth}),
r{depth} as (select *,
  budget - coalesce(sum(case when is_full = 1 then room end) over (partition by {above}), 0) as rest,
  sum(case when is_full = 0 then weight end) over (partition by {above}) as open from f{depth}),
p{depth} as (select *, case when is_full = 1 then room else rest::hugeint * weight // open end as share,
  row_number() over (partition by {above} order by is_full = 1, {name}) as place from r{depth}),
b{depth + 1} as (select {", ".join(path)}, least(room, share + case when is_full = 0 and place <= rest
  - sum(case when is_full = 0 then share end) over (partition by {above}) then 1 else 0 end)::bigint as budget
  from p{depth})"""


EPOCHS = 2
_MIX = f"""
with d as (select doc_id, text, coalesce(lang, '') as lang, coalesce(source, '') as source,
  case when source = 'src0' then 'crawl'
    when try_cast(regexp_extract(source, '[0-9]+') as int) % 3 = 0 then 'books'
    when try_cast(regexp_extract(source, '[0-9]+') as int) % 3 = 1 then 'forums'
    when try_cast(regexp_extract(source, '[0-9]+') as int) % 3 = 2 then 'reference' else '' end as domain,
  greatest(1, ceil(coalesce(strlen(text), 0) / 4))::bigint as n_tokens from documents),
leaves as (select domain, lang, source, {EPOCHS} * sum(n_tokens) as room from d group by all),
b0 as (select least(floor(sum(room) * {MIX_SHARE} / {EPOCHS}), sum(room))::hugeint as budget from leaves),
{",".join(_level(i) for i in range(3))},
o as (select d.*, epoch, budget, coalesce(sum(n_tokens) over (partition by domain, lang, source
    order by epoch, ('0x' || substr(md5(concat_ws(':', '{MIX_SEED}', epoch, n_tokens, md5(coalesce(text, '')),
    coalesce(doc_id::varchar, ''))), 1, {mixing.ORDER_HEX}))::bigint, coalesce(doc_id::varchar, ''), n_tokens,
    md5(coalesce(text, ''))
    rows between unbounded preceding and 1 preceding), 0)::bigint as tokens_before
  from d cross join range({EPOCHS}) t(epoch) join b3 using (domain, lang, source))
select doc_id, domain, lang, source, epoch::int as epoch, n_tokens, tokens_before, budget
from o where tokens_before < budget
"""

_AUDIT = f"""
with d as materialized (select coalesce(lang, '') as lang, coalesce(source, '') as source, row_number() over () as id,
    coalesce(text, '') as text from documents),
t as (select lang, source, id, translate(unnest(regexp_extract_all(text, '{source_divergence.TERM}')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as term from d),
l as materialized (select lang, term, count(*) as n from t group by all having count(distinct id) >= {source_divergence.LEAST_DOCS}),
c as (select lang, source, term, count(*) as n from t semi join l using (lang, term) group by all),
g as (select distinct lang, source from d),
v as (select lang, count(l.term) as kept, coalesce(sum(l.n), 0) as total from (select distinct lang from d) left join l using (lang) group by lang),
s as (select lang, source, coalesce(sum(n), 0) as total from g left join c using (lang, source) group by all),
p as materialized (select lang, source, l.term, coalesce(c.n, 0) as n,
    1 + 1000000000::hugeint * (coalesce(c.n, 0) + 2) // (s.total::hugeint + 2 * kept) as p,
    1 + 1000000000::hugeint * (l.n + 2) // (v.total::hugeint + 2 * kept) as q
  from s join v using (lang) join l using (lang) left join c using (lang, source, term)),
a as (select x.lang, x.source, 'pair' as part, y.source as item,
    coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0)::bigint as value
  from p x join p y using (lang, term) where x.source <> y.source group by all),
b as (select x.lang, x.source, 'pair' as part, y.source as item, coalesce(a.value, 0) as value
  from g x join g y on x.lang = y.lang and x.source <> y.source
  left join a on a.lang = x.lang and a.source = x.source and a.item = y.source
  union all
  select lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::bigint from p where n > 0 and p > q)
select *, (row_number() over (partition by lang, source, part order by value desc, item))::int as rank from b
qualify part = 'pair' or rank <= {source_divergence.BEST_TERMS}
"""

ORACLES = {"op8_mixing": _MIX, "op13_source_divergence": _AUDIT}
