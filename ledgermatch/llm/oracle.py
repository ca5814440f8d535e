"""DuckDB statements for the queries that SQL can express."""

_LIVE = """(regexp_matches(value, '[0-9]') and regexp_matches(value, '[A-Za-z]')
      and not regexp_matches(value, '(?i)(example|sample|dummy|changeme|placeholder|xxxx|your[_-]?)')
      and len(list_distinct(string_split(value, ''))) >= 10)"""


def _found(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    return f"""
  select r, '{kind}' as kind, {order} as k, s, s + length(m) as e, value from (
    select r, m, value,
           sum(length(g) + length(m)) over (partition by r order by i) - length(m) as s
    from (select r, unnest(generate_series(1, len(ms))) as i, unnest(ms) as m, unnest(vs) as value,
                 unnest(gs[1:len(ms)]) as g
          from (select r, regexp_extract_all(t, $p${pattern}$p$) as ms,
                       regexp_extract_all(t, $p${pattern}$p$, {group}) as vs,
                       string_split_regex(t, $p${pattern}$p$) as gs from d)))
  where length(value) >= {least}"""


_ASSIGN = r"""(?i)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

OP1 = f"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t, source as owner,
                  concat_ws('/', source, lang) as repo from documents),
base as ({_found('assign', 0, _ASSIGN, 1, 12)}
  union all {_found('access', 1, 'AKIA[A-Z0-9]{14,}', 0, 0)}
  union all {_found('hex', 2, '[0-9a-f]{16,}', 0, 0)}),
more as (select * from ({_found('live', 3, '[A-Za-z0-9+/_=-]{20,}', 0, 0)}) m
  where {_LIVE} and not exists (select 1 from base b where b.r = m.r and b.s < m.e and m.s < b.e)),
spans as (select * from base union all select * from more),
counts as (select value, count(distinct owner) >= 3 or count(distinct (owner, repo)) >= 6 as shared
  from spans join d using (r) group by value),
judged as (select s.*, shared, {_LIVE.replace('value', 's.value')} as looks from spans s join counts c using (value)),
kept as (select * from judged where k < 3 or (looks and not shared)),
per as (select r, count(*) filter (k = 0) as a, count(*) filter (k = 1) as b, count(*) filter (k = 2) as c,
    string_agg(concat_ws(':', kind, s, e), ',' order by s, k) filter (k < 3) as base_text,
    string_agg(concat_ws(':', kind, s, e), ',' order by s, k) as all_text,
    count(*) filter (k < 3 and shared) as n_shared, count(*) filter (k < 3 and looks and not shared) as n_owned
  from kept group by r)
select doc_id, coalesce(a, 0) as n_assign, coalesce(b, 0) as n_access, coalesce(c, 0) as n_hex,
       sha256(coalesce(base_text, '')) as base_sha256, coalesce(all_text, '') as spans,
       coalesce(n_shared, 0) as n_shared, coalesce(n_owned, 0) as n_owned
from d left join per using (r)
"""

OP10 = r"""
with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
           from documents),
g as (select text_sha256, min(doc_id) as keep_id, count(*) as group_size from d group by 1)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from d join g using (text_sha256)
"""

OP2 = r"""
with l as (select doc_id, i, line, translate(trim(line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, unnest(ls) as line, unnest(generate_series(1, len(ls))) as i
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents))),
f as (select key, max(doc_id) as last from l where length(key) >= 20 group by key having count(distinct doc_id) >= 3),
m as (select l.*, f.key is not null and doc_id <> last as gone from l left join f using (key))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from m group by doc_id
"""

OP3 = """
with d as (select page_id, coalesce(html, '') as h from pages),
s as (select page_id, octet_length(encode(h)) as payload_bytes, sha256(h) as payload_digest from d),
f as (select payload_digest, min(page_id) as first from s where payload_bytes >= 100 group by 1)
select page_id, payload_bytes, payload_digest,
       case when first is null or first = page_id then 'response' else 'revisit' end as record_type,
       case when first <> page_id then first end as refers_to
from s left join f using (payload_digest)
"""

def _share(nodes: str, parent: str, name: str, out: str) -> str:
    """The budget of each parent shared by weight among (name, weight, cap)."""
    part = f"partition by {parent}" if parent else ""
    flagged = f"partition by {parent + ', ' if parent else ''}f"
    order = f"order by cap::double / weight, {name}"
    path = f"{parent + ', ' if parent else ''}{name}"
    return f"""
{out}_a as (select *, coalesce(sum(cap) over ({part} {order} rows between unbounded preceding and 1 preceding), 0) as used,
    sum(weight) over ({part} {order} rows between current row and unbounded following) as wl from {nodes}),
{out}_b as (select *, cap::hugeint * wl <= weight::hugeint * (budget - used) as f from {out}_a),
{out}_c as (select *, budget - coalesce(sum(cap) filter (f) over ({part}), 0) as rest,
    sum(weight) filter (not f) over ({part}) as ws from {out}_b),
{out}_d as (select *, case when f then cap else (weight::hugeint * rest::hugeint) // ws::hugeint end as fl from {out}_c),
{out}_e as (select *, rest - sum(fl) filter (not f) over ({part}) as extra,
    row_number() over ({flagged} {order}) as place from {out}_d),
{out} as (select {path}, (case when f then cap else least(cap, fl + (place <= extra)::int) end)::hugeint as budget
  from {out}_e)"""


OP4 = r"""
with d as (select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source,
    'd' || (('0x' || substr(md5(coalesce(source, '')), 1, 2))::int % 4) as domain,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as n_tokens from documents),
leaf as (select domain, lang, source, sum(n_tokens)::bigint as tokens from d where n_tokens > 0 group by all),
n1 as (select domain, sum(tokens) * 2 as cap,
    case domain when 'd0' then 4 when 'd1' then 3 when 'd2' then 2 else 1 end as weight,
    (select floor(sum(tokens) / 2)::hugeint from leaf) as budget from leaf group by domain),""" + _share(
    "n1", "", "domain", "s1") + """,
n2 as (select domain, lang, cap, case lang when 'en' then 5 when 'de' then 2 when 'fr' then 2 else 1 end as weight, budget
  from (select domain, lang, sum(tokens) * 2 as cap from leaf group by all) join s1 using (domain)),""" + _share(
    "n2", "domain", "lang", "s2") + """,
n3 as (select domain, lang, source, tokens * 2 as cap, 1 as weight, budget from leaf join s2 using (domain, lang)),""" + _share(
    "n3", "domain, lang", "source", "s3") + """,
e as (select d.*, x.epoch::int as epoch, budget as alloc, (x.epoch - 1) * tokens + coalesce(sum(n_tokens) over (
        partition by domain, lang, source, x.epoch order by md5('1:' || x.epoch || ':' || doc_id), doc_id, n_tokens
        rows between unbounded preceding and 1 preceding), 0) as pos
  from d join leaf using (domain, lang, source) join s3 using (domain, lang, source), (values (1), (2)) x(epoch)
  where n_tokens > 0)
select doc_id, domain, lang, source, epoch, n_tokens, least(n_tokens, alloc - pos)::bigint as take_tokens
from e where pos < alloc
"""

_FAR = "{'c': 1000000000000, 'e': '', 't': ''}"


def _edit(front: str, cost: str, initial: str, line: str = "") -> str:
    """The prefix ``front`` with one edit more, as (cost, initials, repaired text)."""
    text = f"case when {front}.t = '' then {line} else {front}.t || chr(10) || {line} end" if line else f"{front}.t"
    return f"{{'c': {front}.c + {cost}, 'e': {front}.e || '{initial}', 't': {text}}}"


def _kept(first: str, front: str) -> str:
    """The prefix with the row kept, where its initial is ``first`` and it need not go."""
    return f"case when not must and left(role, 1) = '{first}' then {_edit(front, '5 * cut', 'K', LINE)} else {_FAR} end"


def _reroled(role: str, front: str) -> str:
    return f"case when not must then {_edit(front, '1 + 5 * cut', 'R', _said(role, 'text'))} else {_FAR} end"


def _said(role: str, text: str) -> str:
    return f"'{role}:' || {text}"


LINE = "role || ':' || text"
_USER, _ASSISTANT = _said("user", "''"), _said("assistant", "''")

# forward: per conversation the least (cost, initials) that leaves the text so far empty (f0) or ending in s, u, a (f1, f2, f3)
OP11 = f"""
with recursive
table256 as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k:
    case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc),
original as (select dense_rank() over (order by conv_id nulls first) as g, conv_id, turn, coalesce(role, ' ') as role,
    coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name from conversations),
hits as (select * exclude (name), xor(list_reduce(list_prepend(4294967295, list_transform(string_split(name, ''), lambda x: ascii(x)::bigint)),
    lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 20 as hit from original, table256),
damaged as (select g, turn, case hit when 4 then 'user' else role end as role,
    case hit when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
  from hits, range(2) as copies(n) where hit <> 0 and (n = 0 or hit = 3)),
placed as (select *, row_number() over (partition by g order by turn nulls first, sha256(length(role) || ':' || role || text)) as i,
    right(rtrim(text, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)), 1) as final from damaged),
seen as (select *, row_number() over (partition by g, role, text order by i) > 1 as again,
    left(lag(role) over (partition by g order by i), 1) || left(role, 1) as step from placed),
judged as (select *, final = '' or again as must, (final <> '' and not again and final not in ('.', '!', '?'))::int as cut from seen),
walk as (
  select distinct g, 0::bigint as i, {{'c': 0::bigint, 'e': '', 't': ''}} as f0, {_FAR} as f1,
    {{'c': 5::bigint, 'e': 'I', 't': 'user:'}} as f2,
    {{'c': 10::bigint, 'e': 'II', 't': 'user:' || chr(10) || 'assistant:'}} as f3 from original
  union all
  select g, i, z0, z1, y2, list_min([z3, {_edit('y2', '5', 'I', _ASSISTANT)}]) from (
    select *, list_min([z2, {', '.join(_edit(z, '5', 'I', _USER) for z in ('z0', 'z1', 'z3'))}]) as y2 from (
      select w.g, j.i, {_edit('f0', '2', 'D')} as z0,
        list_min([{_edit('f1', '2', 'D')}, {_kept('s', 'f0')}]) as z1,
        list_min([{_edit('f2', '2', 'D')}, {', '.join(f"{_kept('u', f)}, {_reroled('user', f)}" for f in ('f0', 'f1', 'f3'))}]) as z2,
        list_min([{_edit('f3', '2', 'D')}, {_kept('a', 'f2')}, {_reroled('assistant', 'f2')}]) as z3
      from walk w join judged j on j.g = w.g and j.i = w.i + 1))),
ends as (select g, arg_max(list_min([f0, f3]), i) as best from walk group by g),
counts as (select g, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (final = '') as blank,
    count(*) filter (final <> '' and again) as duplicate, sum(cut) as truncated,
    count(*) filter (step not in ('su', 'ua', 'au')) as illegal from judged group by g)
select conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0) as illegal, best.c as cost, best.e as audit,
       sha256(best.t) as repaired_sha256
from (select distinct g, conv_id from original) join ends using (g) left join counts using (g)
"""

ORACLE = {"op1_secret_scan": OP1, "op2_line_dedup": OP2, "op3_warc_zip": OP3, "op4_source_mix": OP4,
          "op10_exact_dedup": OP10, "op11_conversation_repair": OP11}
