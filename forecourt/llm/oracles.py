"""DuckDB SQL for the queries of this subpackage that SQL can express, written independently of them."""

from __future__ import annotations

LOWERED = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(table: str, name: str) -> str:
    """Per row of a table: its id and the list of its words."""
    return f"select {name}, regexp_extract_all({LOWERED.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') as w from {table}"


def shingles(source: str, name: str, k: int) -> str:
    """Distinct runs of k words of each row with so many."""
    run = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    return f"select distinct {name}, {run} as gram from (select {name}, w, unnest(range(1, len(w) - {k - 2})) as i from {source} where len(w) >= {k})"


def spans(kind: str, order: int, pattern: str) -> str:
    """Leftmost, non-overlapping matches with their positions: pieces between them and matches have lengths that add up."""
    quoted = pattern.replace("'", "''")
    length = "coalesce(list_sum(list_transform({0}, lambda x: length(x))), 0)"
    return f"""select doc_id, '{kind}' as kind, {order} as place, m[i] as m, {length.format('p[1:i]')} + {length.format('m[1:i-1]')} as a
 from (select doc_id, m, p, unnest(range(1, len(m) + 1)) as i from (
 select doc_id, regexp_extract_all(text, '{quoted}') as m, regexp_split_to_array(text, '{quoted}') as p from texts))"""


def any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# --- chat --------------------------------------------------------------------------------

_CONTROLS = r"<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>"
_ESCAPED = r"length({0}) + length({0}) - length(replace({0}, '\', '')) + len(regexp_extract_all({0}, '" + _CONTROLS + "'))"
CHAT = f"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) as place from said
)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by place)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by place) filter (where role = 'assistant'), '')) as loss_sha256,
  sum({_ESCAPED.format('role')} + length(role) - length(replace(role, chr(10), '')) + {_ESCAPED.format('text')} + 24)::bigint as formatted_chars
from placed group by conv_id
"""

# --- near-duplicates ---------------------------------------------------------------------

NEAR_DUPLICATES = f"""
with recursive words as ({words('documents', 'doc_id')}),
grams as (
  {shingles('words', 'doc_id', 3)}
  union all select doc_id, array_to_string(w, ' ') from words where len(w) between 1 and 2
), sizes as (select doc_id, count(*) as n from grams group by doc_id),
links as (
  select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as c from grams x join grams y using (gram) where x.doc_id < y.doc_id group by all)
  join sizes s on s.doc_id = a join sizes t on t.doc_id = b where 100 * c >= 85 * (s.n + t.n - c)
), both_ways as (select a, b from links union all select b, a from links),
reached as (
  select doc_id as node, doc_id as seen from documents
  union select b, seen from reached join both_ways on a = node
), smallest as (select node, min(seen) as component_id from reached group by node)
select d.doc_id, coalesce(s.n, 0) as n_shingles, component_id, d.doc_id = component_id as kept
from documents d join smallest on node = d.doc_id left join sizes s on s.doc_id = d.doc_id
"""

# --- decontamination ---------------------------------------------------------------------

LEAKS = f"""
with doc_words as ({words('documents', 'doc_id')}), item_words as ({words('benchmark', 'item_id')}),
doc_grams as ({shingles('doc_words', 'doc_id', 5)}), item_grams as ({shingles('item_words', 'item_id', 5)}),
sizes as (select item_id, count(*) as n_item from item_grams group by item_id),
shared as (select doc_id, item_id, count(*) as n_shared from doc_grams join item_grams using (gram) group by doc_id, item_id)
select doc_id, item_id, n_shared, n_item, n_shared / n_item as containment from shared join sizes using (item_id) where 10 * n_shared >= 8 * n_item
"""

# --- near vectors ------------------------------------------------------------------------

NEAR_VECTORS = """
with recursive fine as (
  select vec_id, label, embedding::double[] as v from embeddings
  where label is not null and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0 and len(list_filter(embedding, lambda c: c <> 0)) > 0
), links as (
  select x.vec_id as a, y.vec_id as b from fine x join fine y on x.label = y.label and x.vec_id < y.vec_id and len(x.v) = len(y.v)
  where list_cosine_similarity(x.v, y.v) >= 0.93
), both_ways as (select a, b from links union all select b, a from links),
reached as (
  select vec_id as node, vec_id as seen from embeddings
  union select b, seen from reached join both_ways on a = node
), smallest as (select node, min(seen) as component_id from reached group by node),
degrees as (select a, count(*) as n_links from both_ways group by a)
select vec_id, coalesce(n_links, 0) as n_links, component_id, vec_id = component_id as kept
from embeddings join smallest on node = vec_id left join degrees on a = vec_id
"""

# --- repeated strings, on the hexadecimal digits of a text's bytes ------------------------

REPEATS = """
with texts as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
windows as (
  select doc_id, p, md5_number(substr(h, 2 * p + 1, 200)) as string from (select doc_id, h, unnest(range(0, length(h) // 2 - 99)) as p from texts)
), ranked as (select *, row_number() over (partition by string order by doc_id, p) as place from windows),
again as (select doc_id, p, lag(p) over (partition by doc_id order by p) as q from ranked where place > 1),
runs as (
  select doc_id, min(p) as a, max(p) + 100 as b from (
    select *, count(*) filter (where q is null or p > q + 100) over (partition by doc_id order by p) as run from again
  ) group by doc_id, run
), kept as (
  select doc_id, count(*) as n_spans, sum(b - a) as n_removed, string_agg(substr(h, 2 * coalesce(c, 0) + 1, 2 * (a - coalesce(c, 0))), '' order by a) as front, max(b) as last
  from (select *, lag(b) over (partition by doc_id order by a) as c from runs) join texts using (doc_id) group by doc_id
)
select doc_id, (length(h) // 2)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(case when last is null then h else front || substr(h, 2 * last + 1) end)) as kept_sha256
from texts left join kept using (doc_id)
"""

# --- mixing ------------------------------------------------------------------------------

TARGETS = f"""
with words as ({words('documents', 'doc_id')}),
sources as (select source, sum(len(w))::bigint as source_size from words join documents using (doc_id) group by source),
weighed as (select *, [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as weight from sources),
ordered as (
  select *, 2.0 * source_size / weight as level, row_number() over (order by source_size / weight, source) as place from weighed
), tried as (
  select place, level, ((select 1.5 * sum(source_size) from sources) - coalesce(sum(2 * source_size) over (order by place rows between unbounded preceding and 1 preceding), 0))
    / sum(weight) over (order by place rows between current row and unbounded following) as share from ordered
), found as (select share from tried where share <= level order by place limit 1)
select source, source_size, round(least(2.0 * source_size, coalesce((select share from found) * weight, 2.0 * source_size)), 3)::double as target from ordered
"""

# --- secrets and personal data: the base spans -------------------------------------------

_NAMES = "|".join(map(any_case, ("password", "passwd", "secret", "token", "api_?key")))
_ASSIGN = rf"""(?:{_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_VALUE = _ASSIGN.replace("'", "''")
SECRETS = f"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
found as (
  select * from ({spans('assign', 0, _ASSIGN)}) where length(regexp_extract(m, '{_VALUE}', 1)) >= 12
  union all select * from ({spans('access', 1, 'AKIA[A-Z0-9]+')}) where length(m) >= 18
  union all select * from ({spans('hex', 2, '[0-9a-f]+')}) where length(m) >= 16
), by_doc as (
  select doc_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access,
    count(*) filter (where kind = 'hex') as n_hex, string_agg(kind || ':' || a || ':' || a + length(m), ',' order by a, place) as base from found group by doc_id
)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256
from texts left join by_doc using (doc_id)
"""

_DIGITS = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(length({_DIGITS})),
 lambda i: case when i % 2 = 0 then substr(reverse({_DIGITS}), i + 1, 1)::int else [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][substr(reverse({_DIGITS}), i + 1, 1)::int + 1] end)) % 10 = 0"""
PERSONAL = f"""
with texts as (select doc_id, coalesce(text, '') as text from documents),
found as (
  select * from ({spans('email', 0, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+')})
  union all select * from ({spans('ip', 1, '[0-9]+(?:[.][0-9]+){3}')})
   where list_bool_and(list_transform(string_split(m, '.'), lambda part: length(ltrim(part, '0')) <= 3 and (substr('0' || ltrim(part, '0'), 1, 4))::int <= 255))
  union all select * from ({spans('card', 2, '[0-9](?:[ -]?[0-9])+')}) where length({_DIGITS}) between 16 and 19 and {_LUHN}
  union all select * from ({spans('phone', 3, '[+][0-9][ ().0-9-]+[0-9]')}) where length({_DIGITS}) between 8 and 15
), by_doc as (
  select doc_id, count(*) filter (where kind = 'email') as n_email, count(*) filter (where kind = 'ip') as n_ip,
    count(*) filter (where kind = 'card') as n_card, count(*) filter (where kind = 'phone') as n_phone,
    string_agg(kind || ':' || a || ':' || a + length(m), ',' order by place, a) as base from found group by doc_id
)
select doc_id, coalesce(n_email, 0) as n_email, coalesce(n_ip, 0) as n_ip, coalesce(n_card, 0) as n_card, coalesce(n_phone, 0) as n_phone,
  sha256(coalesce(base, '')) as base_sha256
from texts left join by_doc using (doc_id)
"""

# --- urls --------------------------------------------------------------------------------

URLS = """
with cut as (
  select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages
), named as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as name, substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1) as tail from cut
), parts as (
  select page_id, translate(name, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(tail, '^[^?#]*') as path
  from named
), rules(rule_host, rule_path, says) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fitting as (
  select page_id, host, path, max(struct_pack(n := length(rule_host || rule_path), rule := rule_host || rule_path, says := says)) as best
  from parts left join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
  group by page_id, host, path
)
select page_id, host, path, best.rule as rule, coalesce(best.says, case when len(list_intersect(string_split(host, '.'),
  ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm'])) > 0 then 'block' else 'allow' end) as verdict
from fitting
"""

# --- resampling --------------------------------------------------------------------------

RESAMPLED = r"""
with docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words from documents
), items as (
  select unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as word from benchmark
), occurrences as (select doc_id, unnest(words) as word from docs),
per_doc as (select doc_id, word, count(*) as n from occurrences group by doc_id, word),
spelled as (
  select word, hex(encode(word)) as code from (select word from per_doc union select word from items)
), steps as (
  select word, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(length(code) // 2),
    lambda i: ('0x' || substr(code, 2 * i + 1, 2))::bigint)),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)),
    4294967295::bigint) % 10000 as bucket
  from spelled
), sources as (select bucket, sum(n) as s from per_doc join steps using (word) group by bucket),
targets as (select bucket, count(*) as t from items join steps using (word) group by bucket),
counts as (
  select bucket, coalesce(s, 0)::double as s, coalesce(t, 0)::double as t
  from range(10000) b(bucket) left join sources using (bucket) left join targets using (bucket)
), gains as (
  select bucket, floor(1000 * ln((t + 1) * ((select sum(s) from counts) + 10000) / ((s + 1) * ((select sum(t) from counts) + 10000))))::bigint as gain
  from counts
), weights as (
  select doc_id, sum(n * gain)::bigint as weight from per_doc join steps using (word) join gains using (bucket) group by doc_id
), scored as (
  select doc_id, len(words)::bigint as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::bigint + 0.5::double) / 4294967296)))::bigint as score
  from docs left join weights using (doc_id)
), able as (
  select doc_id, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_features >= 20
)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end as rank from scored left join able using (doc_id)
"""

ORACLES = {
    "op2_sphere": NEAR_VECTORS,
    "op4_chat": CHAT,
    "op5_minhash": NEAR_DUPLICATES,
    "op6_suffixes": REPEATS,
    "op7_decontamination": LEAKS,
    "op11_urls": URLS,
    "op13_resampling": RESAMPLED,
    "mixing_targets": TARGETS,
    "secrets_base": SECRETS,
    "pii_base": PERSONAL,
}
