"""DuckDB statements for the queries that SQL can express."""

WORD = r"[^\x20\x09-\x0D]+"

URL_PARTS = r"""
  select page_id, url, html, day,
    nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '\.+$', ''), '') as host,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) as path
  from (select *, date '2021-01-01' + cast(page_id * 7919 % 1000 as int) as day from pages)
"""

OP3 = rf"""
with parts as ({URL_PARTS}),
captures as (
  select page_id, url, html, day, host, host || case when path = '' then '/' else path end as page from parts
),
entries as (
  select unnest([page, host]) as address, day + 1 as day,
    case when marks >= 3 then 2 when marks = 0 then 0 end as state
  from (select *, len(regexp_extract_all(coalesce(html, ''), '[0-9A-Za-z_](\*\*\*|###|\$\$\$|%%%|&&&)')) as marks from captures)
),
daily as (
  select address, day, max(state) as state from entries
  where address is not null and state is not null group by address, day
),
turns as (
  select *, coalesce(lag(state) over (partition by address order by day), 0) as was from daily
),
spans as (
  select address, state, day as from_day, lead(day) over (partition by address order by day) as to_day
  from turns where state <> was
),
keys as (
  select page_id, day, page as address, 0 as rank from captures where host is not null
  union all
  select page_id, day, array_to_string(labels[i:], '.') as address, i as rank
  from (select page_id, day, string_split(host, '.') as labels from captures where host is not null),
    lateral (select unnest(range(1, len(labels) + 1)) as i)
),
met as (
  select page_id, rank, address, state from keys join spans using (address)
  where state > 0 and from_day <= day and (to_day is null or day < to_day)
),
verdicts as (
  select page_id, min({{'rank': rank, 'mild': 2 - state, 'address': address}}) as first, count(*) as active from met group by page_id
)
select page_id, url, day, coalesce(first.mild = 0, false) as blocked, first.address as decided_by,
  cast(first.rank as int) as decided_rank, coalesce(active, 0) as active_entries
from captures left join verdicts using (page_id)
"""

OP5 = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
whole as (
  select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as learned,
    sum(15 + length(role) + length(replace(replace(role, '\', '\\'), '>', '\>')) - length(role)
      + length(replace(replace(replace(text, '\', '\\'), '<turn', '\<turn'), '</turn', '\</turn'))) as formatted_chars
  from rows group by conv_id
)
select conv_id, n_turns, turns_sha256, length(learned) as loss_chars, sha256(learned) as loss_sha256,
  cast(formatted_chars as bigint) as formatted_chars
from whole
"""

OP7 = rf"""
with recursive worded as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') as w
  from documents
),
sets as (
  select distinct doc_id, array_to_string(w[i : i + 4], ' ') as shingle
  from worded, lateral (select unnest(range(1, greatest(1, len(w) - 4) + 1)) as i) where len(w) > 0
),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from sets a join sets b on a.shingle = b.shingle and a.doc_id < b.doc_id group by a.doc_id, b.doc_id
),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * common >= 75 * (x.n + y.n - common)
),
both_ways as (select a, b from links union all select b, a from links),
reach as (
  select doc_id as start, doc_id as node from worded
  union
  select reach.start, both_ways.b from reach join both_ways on reach.node = both_ways.a
)
select doc_id, coalesce(n, 0) as n_shingles, component_id, doc_id = component_id as kept
from (select start as doc_id, min(node) as component_id from reach group by start) left join sizes using (doc_id)
"""

OP8 = r"""
with digests as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as hex from pages
),
coded as (
  select *, list_transform(range(8), lambda k: cast('0x' || substr(hex, 5 * k + 1, 5) as bigint)) as chunks from digests
),
named as (
  select page_id, payload_bytes, hex, array_to_string(list_transform(chunks, lambda v:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 15) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 10) % 32 + 1, 1)
    || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (v >> 5) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', v % 32 + 1, 1)), '') as payload_digest,
    min(page_id) over (partition by hex) as first_id
  from coded
)
select page_id, payload_bytes, payload_digest, case when page_id = first_id then 'response' else 'revisit' end as record_type,
  case when page_id <> first_id then first_id end as refers_to
from named
"""

OP9 = rf"""
with texts as (select doc_id, source, coalesce(text, '') as text from documents),
worded as (
  select doc_id, source, text, regexp_extract_all(text, '{WORD}') as w,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{WORD}')) as lines
  from texts
),
windows as (
  select doc_id, i, w[i : i + 2] as three
  from worded, lateral (select unnest(range(1, len(w) - 1)) as i) where len(w) >= 3
),
repeated as (
  select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, three) as n from windows) where n > 1
),
covered as (
  select doc_id, count(distinct i + k) as n from repeated, (select unnest([0, 1, 2]) as k) group by doc_id
),
counts as (
  select doc_id, source, len(w) as n_words,
    coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) as word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
    len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(n, 0) as n_repeat_words
  from worded left join covered using (doc_id)
),
failed as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts),
hosts as (
  select source, cast(count(*) as double) as n, cast(count(*) filter (base_failed) as double) as f
  from failed where source is not null group by source
),
sums as (
  select sum(n) as docs, sum(f) as failed, count(*) as hosts, sum(n * n) as n2, sum(f * f / n) as f2 from hosts
),
moments as (
  select *, failed / nullif(docs, 0) as mean, (f2 - docs * (failed / nullif(docs, 0)) * (failed / nullif(docs, 0))) / nullif(hosts - 1, 0) as between_hosts,
    (failed - f2) / nullif(docs - hosts, 0) as within_hosts, (docs - n2 / nullif(docs, 0)) / nullif(hosts - 1, 0) as size
  from sums
),
prior as (
  select mean, greatest(1e0, least(1000e0, coalesce(mean * (1 - mean)
    / nullif(greatest(0e0, (between_hosts - within_hosts) / nullif(size, 0)), 0) - 1, 1000e0))) as weight
  from moments
),
rated as (select source, (f + mean * weight) / (n + weight) as host_rate from hosts, prior)
select doc_id, n_words, cast(word_chars as bigint) as word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, round(host_rate, 9) as host_rate,
  not base_failed and coalesce(host_rate, 0) <= 0.5 as kept
from failed left join rated using (source)
"""

FINITE = "embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0"

OP11 = f"""
with kept as (
  select vec_id, list_transform(embedding, lambda x: floor(64e0 * x)) as v from embeddings where {FINITE}
),
scored as (
  select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
  from kept q join kept c on c.vec_id <> q.vec_id where q.vec_id % 20 = 0
),
ranked as (
  select query_id, vec_id, score, row_number() over (partition by query_id order by score desc, vec_id) as place from scored
)
select query_id, cast(place as int) as rank, vec_id, score from ranked where place <= 20
"""

# Nearest centroid of every vector: the smallest (distance, number).
NEAREST = """
  select vec_id, v, unnest(min({{'d': cast(list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c) as bigint), 'cluster': cluster}}))
  from kept, c{k} group by vec_id, v
"""

MOVED = """
c{next} as (
  select c{k}.cluster, coalesce(list_transform(sums, lambda s: floor((s - ((s % n) + n) % n) / n)), c) as c
  from c{k} left join (
    select cluster, any_value(n) as n, list(s order by pos) as sums
    from (select cluster, pos, count(*) as n, sum(x) as s from (
      select cluster, unnest(range(1, 65)) as pos, unnest(v) as x from a{k}) group by cluster, pos) group by cluster) m using (cluster)
)"""

ROUNDS = ", ".join(
    f"a{k} as ({NEAREST.format(k=k)})" + ("," + MOVED.format(k=k, next=k + 1) if k < 5 else "") for k in range(6)
)

OP12 = f"""
with kept as (
  select vec_id, list_transform(embedding, lambda x: floor(256e0 * x)) as v from embeddings where {FINITE} and len(embedding) = 64
),
c0 as (
  select row_number() over (order by sha256('2:' || vec_id)) - 1 as cluster, v as c from kept order by sha256('2:' || vec_id) limit 40
),
{ROUNDS},
sums as (select cluster, sum(d) as own from a5 group by cluster)
select vec_id, cast(cluster as int) as cluster, d as distance, cast(own as bigint) as cluster_inertia,
  cast(sum(d) over () as bigint) as inertia,
  sha256(array_to_string(list_transform(c, lambda x: cast(cast(x as bigint) as varchar)), ',')) as centroid_sha256
from a5 join c5 using (cluster) join sums using (cluster)
"""

# CRC-32 of a word, byte by byte over its hexadecimal digits.
OP13 = r"""
with crc_table as (
  select list(c order by i) as entries from (
    select i, list_reduce(list_prepend(i, range(8)), lambda c, k: case when c % 2 = 1 then xor(c // 2, 3988292384) else c // 2 end) as c
    from (select unnest(range(256)) as i))
),
texts as (
  select 0 as kind, row_number() over () as row, doc_id, text from documents
  union all select 1, row_number() over (), null, text from benchmark
),
worded as (
  select kind, row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as words
  from texts
),
single as (select kind, row, unnest(words) as word from worded),
grouped as (select kind, row, word, count(*) as n from single group by kind, row, word),
coded as (
  select word, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(hex(word)) // 2 + 1),
    lambda k: cast(cast('0x' || substr(hex(word), 2 * k - 1, 2) as int) as bigint))),
    lambda c, b: xor(c // 256, entries[xor(c % 256, b) + 1])), 4294967295) % 10000 as bucket
  from (select distinct word from grouped), crc_table
),
counts as (
  select bucket, cast(coalesce(sum(n) filter (kind = 0), 0) as double) as s, cast(coalesce(sum(n) filter (kind = 1), 0) as double) as t
  from grouped join coded using (word) group by bucket
),
totals as (select sum(s) as of_all, sum(t) as of_target from counts),
gains as (
  select bucket, cast(floor(1000e0 * ln((t + 1e0) * (of_all + 10000e0) / ((s + 1e0) * (of_target + 10000e0)))) as bigint) as gain from counts, totals
),
weights as (
  select row, sum(n * gain) as weight from grouped join coded using (word) join gains using (bucket) where kind = 0 group by row
),
scored as (
  select doc_id, row, cast(len(words) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
    cast(coalesce(weight, 0) as bigint) + cast(floor(-1000e0 * ln(-ln((cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) + 0.5e0) / 4294967296e0))) as bigint) as score
  from worded left join weights using (row) where kind = 0
),
ranked as (
  select row, row_number() over (order by score desc, doc_id) as place, count(*) over () as n from scored where n_features >= 20
)
select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end as rank
from scored left join ranked using (row)
"""

ORACLE = {
    "op3_url_lists": OP3,
    "op5_chat": OP5,
    "op7_near_duplicates": OP7,
    "op8_warc": OP8,
    "op9_quality_rules": OP9,
    "op11_vector_files": OP11,
    "op12_centroid_search": OP12,
    "op13_target_resampling": OP13,
}
