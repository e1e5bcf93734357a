"""The operators as queries over whole tables, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from codeledger.llm import (
    collocations,
    conversation_repair,
    decontamination,
    license_scan,
    lm_scores,
    quality,
    quotes,
    sentencepiece_codec,
    simhash,
    substring_dedup,
    token_frames,
    url_filters,
    warc,
)
from codeledger.llm.tables import table
from codeledger.session import checkpointed

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, keep_text=False)


OP1_SQL = rf"""
with d as (select doc_id, {WORDS} as w from documents),
p as (select doc_id, w, unnest(range(1, len(w) - 11)) as i from d where len(w) >= 13),
g as (select doc_id, i, array_to_string(w[i:i + 12], ' ') as k from p),
f as (select k, min(doc_id) as m from g group by k),
c as (select distinct doc_id, unnest(range(i, i + 13)) as j from g join f using (k) where m < doc_id),
r as (select doc_id, list(j) as js from c group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(len(js), 0)::bigint as n_removed,
  sha256(array_to_string(case when js is null then w
    else list_filter(w, lambda x, i: not list_contains(js, i)) end, ' ')) as kept_sha256
from d left join r using (doc_id)
"""


def op2_sentencepiece_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece_codec.encode(docs)


def op3_redirect_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(table(spark, sf_dir, "pages")).drop("component")


#: The rules alone: the given pages hold no redirect and no canonical link.
OP3_SQL = r"""
with p as (
  select page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') as path
  from pages),
r(verdict, h, p) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
m as (
  select page_id, h || r.p as rule, verdict,
    row_number() over (partition by page_id order by length(h || r.p) desc) as place
  from p join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, r.p))
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict
from p left join (select * from m where place = 1) using (page_id)
"""


def op4_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.link_quotes(table(spark, sf_dir, "conversations"))


def op5_bit_sliced_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_warc_merged_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.write_archives(table(spark, sf_dir, "pages"))
    index = warc.merged_index(warc.read_runs(spark, folder))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "captured")


OP6_SQL = """
with p as (select page_id, coalesce(html, '') as h from pages),
q as (select page_id, strlen(h)::bigint as n, sha256(h) as g, min(page_id) over (partition by sha256(h)) as first from p)
select page_id, n as payload_bytes, g as payload_digest,
  case when n >= 100 and page_id > first then 'revisit' else 'response' end as record_type,
  case when n >= 100 and page_id > first then first end as refers_to,
  strftime(timestamp '2024-01-01 00:00:00' + to_seconds(page_id), '%Y-%m-%dT%H:%M:%SZ') as captured
from q
"""


def op7_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _seed_sql(mask: tuple[int, ...]) -> str:
    return " || ' ' || ".join(f"w[i + {offset}]" for offset in mask)


OP7_SQL = rf"""
with d as (select doc_id, string_split(trim(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') as w from documents),
b as (select item_id, string_split(trim(regexp_replace(lower(text), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ') as w from benchmark),
dp as (select doc_id, w, unnest(range(1, len(w) - 6)) as i from d where len(w) >= 8),
bp as (select item_id, w, unnest(range(1, len(w) - 6)) as i from b where len(w) >= 8),
ds as (select doc_id, i, unnest(['0 ' || {_seed_sql(decontamination.MASKS[0])}, '1 ' || {_seed_sql(decontamination.MASKS[1])}]) as s from dp),
bs as (select item_id, i, unnest(['0 ' || {_seed_sql(decontamination.MASKS[0])}, '1 ' || {_seed_sql(decontamination.MASKS[1])}]) as s from bp),
h as (select distinct doc_id, item_id, ds.i - bs.i as shift from ds join bs using (s)),
e as (select h.doc_id, h.item_id, h.shift, least(13, len(b.w)) as n, unnest(range(1, len(b.w) - least(13, len(b.w)) + 2)) as t,
    b.w as bw, d.w as dw
  from h join b using (item_id) join d using (doc_id)),
v as (select doc_id, item_id, n, list_sum([if(bw[x] = dw[x + shift], 1, 0) for x in range(t, t + n)]) as same
  from e where t + shift >= 1 and t + n - 1 + shift <= len(dw))
select doc_id, item_id, max(same)::bigint as n_equal from v group by doc_id, item_id having max(same) >= ceil(max(n) * 0.8)
"""


def op8_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    rows = checkpointed(quality.measured(docs).drop("text"))
    judged = quality.judged(rows, quality.thresholds(quality.sketches(rows)))
    return judged.drop("lang", "source")


_LIMIT_SQL = "\n".join(
    f"  select lang, source, '{name}' as m, {name} as v, {floor} as least from y where not base_failed"
    + (" union all" if name != list(quality.MEASURES)[-1] else "")
    for name, floor in quality.MEASURES.items()
)
OP8_SQL = rf"""
with d as (
  select doc_id, lang, source, coalesce(text, '') as t, {WORDS} as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l
  from documents),
p as (select doc_id, w, unnest(range(1, len(w) - 6)) as i from d where len(w) >= 8),
g as (select doc_id, i, array_to_string(w[i:i + 7], ' ') as k from p),
f as (select doc_id, k from g group by all having count(*) > 1),
c as (select doc_id, count(distinct j) as n from (select doc_id, unnest(range(i, i + 8)) as j from g join f using (doc_id, k)) group by 1),
x as (
  select doc_id, lang, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words, len(l) as n_lines
  from d left join c using (doc_id)),
y as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    n_symbols * 1000 // greatest(n_words, 1) as symbols, n_dup_lines * 1000 // greatest(n_lines, 1) as dup_lines,
    n_repeat_words * 1000 // greatest(n_words, 1) as repeats, word_chars * 100 // greatest(n_words, 1) as word_length
  from x),
s as (
{_LIMIT_SQL}),
h as (select lang, source, m, least, if(v < 32, v, (v >> (length(bin(v)) - 5)) << (length(bin(v)) - 5)) as bin, count(*) as n
  from s group by all),
k as (select *, sum(n) over (partition by lang, source, m order by bin) as below, sum(n) over (partition by lang, source, m) as total from h),
q as (select lang, source, m, any_value(least) as least, min(bin) filter (4 * below >= total) as q1,
    min(bin) filter (4 * below >= 3 * total) as q3 from k group by all),
u as (select *, greatest(3 * greatest(q3 - q1, least), 1 << greatest(length(bin(q3)) - 5, 0)) as reach from q),
z as (select lang, source, m, q1 - reach as low, q3 + reach as high from u),
o as (
  select y.doc_id, count(*) filter (case m when 'symbols' then symbols when 'dup_lines' then dup_lines when 'repeats' then repeats
    else word_length end between low and high) as good
  from y join z on y.lang is not distinct from z.lang and y.source is not distinct from z.source group by y.doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce(good, 0) = {len(quality.MEASURES)} as kept
from y left join o using (doc_id)
"""


def op9_seekable_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_frames.write_tokens(table(spark, sf_dir, "documents"))
    return token_frames.read_tokens(spark, folder)


def op10_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores.score(table(spark, sf_dir, "documents"))


OP10_SQL = rf"""
with d as (select doc_id, {WORDS} as w from documents),
p as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from d),
g as (
  select doc_id, i, w[i] as w1, case when i > 1 then w[i - 1] || ' ' || w[i] end as w2,
    case when i > 2 then w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] end as w3
  from p),
c1 as (select w1, count(*) as c from g group by 1),
c2 as (select w2, count(*) as c from g where w2 is not null group by 1 having count(*) >= 2),
c3 as (select w3, count(*) as c from g where w3 is not null group by 1 having count(*) >= 2),
t as (select doc_id, i, c1.c as u, c2.c as b, c3.c as t from g join c1 using (w1) left join c2 using (w2) left join c3 using (w3)),
x as (select *, lag(u) over (partition by doc_id order by i) as pu, lag(b) over (partition by doc_id order by i) as pb from t),
y as (
  select doc_id, (t is null and b is null)::int as a,
    case when t is not null then round(1e6 * ln(t))::bigint - round(1e6 * ln(pb))::bigint
      when b is not null then round(1e6 * ln(b))::bigint - round(1e6 * ln(pu))::bigint + (least(i, 3) - 2) * round(1e6 * ln(0.4))::bigint
      else round(1e6 * ln(u))::bigint - (select round(1e6 * ln(count(*)))::bigint from g)
        + (least(i, 3) - 1) * round(1e6 * ln(0.4))::bigint end as s
  from x),
z as (select doc_id, sum(s)::bigint as s, sum(a)::bigint as a from y group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(a, 0)::bigint as n_unigram, coalesce(s, 0)::bigint as score_micro
from d left join z using (doc_id)
"""

def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair(conversation_repair.damage(conversations), conversations)


#: Ways to go on from a state (0 nothing, 1 system, 2 user, 3 assistant) before a row: inserts, their letters, lines and cost.
_INSERTS = """(0, 0, '', '', 0), (1, 1, '', '', 0), (2, 2, '', '', 0), (3, 3, '', '', 0),
  (0, 2, 'I', chr(10) || 'user:', 5), (1, 2, 'I', chr(10) || 'user:', 5), (3, 2, 'I', chr(10) || 'user:', 5),
  (2, 3, 'I', chr(10) || 'assistant:', 5),
  (0, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 10), (1, 3, 'II', chr(10) || 'user:' || chr(10) || 'assistant:', 10)"""
#: crc32 byte by byte, from a table of 256 made bit by bit; the cheapest edits as a recursion over rows and states.
OP11_SQL = rf"""
with recursive
o as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
z as (select list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
  lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as t),
f as (select o.*, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda x: ord(x)::bigint)),
  lambda c, b: xor(c >> 8, z.t[(xor(c, b) & 255) + 1]))) % 20 as fault from o, z),
d as (select conv_id, turn, case when fault = 4 then 'user' else role end as role,
    case when fault = 1 then '' when fault = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
    unnest(case when fault = 3 then [0, 1] else [0] end) as copy
  from f where fault <> 0),
n as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i from d),
g as (select *, row_number() over (partition by conv_id, role, text order by i) as seen, left(role, 1) as r,
    lag(left(role, 1)) over (partition by conv_id order by i) as before, right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) as ends
  from n),
h as (select *, case when ends = '' then 'blank' when seen > 1 then 'duplicate' when ends not in ('.', '!', '?') then 'truncated' end as fault from g),
ins(p, q, letters, lines, c) as (values {_INSERTS}),
nxt(q, role, s) as (values (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
keep(q, r, s) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
m as (
  select conv_id, i, q, q as s, 'D' as letter, '' as line, 2 as c from h, nxt
  union all
  select conv_id, i, q, s, 'K', chr(10) || role || ':' || text, if(fault is null, 0, 5) from h join keep using (r)
  where fault is null or fault = 'truncated'
  union all
  select conv_id, i, q, s, 'R', chr(10) || nxt.role || ':' || text, 1 + if(fault is null, 0, 5) from h, nxt
  where fault is null or fault = 'truncated'),
w(conv_id, i, q, b) as (
  select distinct conv_id, 0::bigint, 0, {{'c': 0, 'audit': '', 'lines': ''}} from d
  union all
  select w.conv_id, m.i, m.s, min({{'c': b.c + ins.c + m.c, 'audit': b.audit || letters || letter, 'lines': b.lines || ins.lines || line}})
  from w join ins on ins.p = w.q join m on m.conv_id is not distinct from w.conv_id and m.i = w.i + 1 and m.q = ins.q
  group by w.conv_id, m.i, m.s),
e as (select w.conv_id, min({{'c': b.c + ins.c, 'audit': b.audit || letters, 'lines': b.lines || ins.lines}}) as b
  from w join ins on ins.p = w.q join (select conv_id, max(i) as i from h group by 1) x
    on x.conv_id is not distinct from w.conv_id and x.i = w.i
  where ins.q in (0, 3) group by w.conv_id),
k as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'blank') as blank,
    count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
    count(*) filter (before is not null and before || r not in ('su', 'ua', 'au')) as illegal
  from h group by 1)
select i.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
  coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(b.c, 0)::bigint as cost,
  coalesce(b.audit, '') as audit, sha256(coalesce(b.lines[2:], '')) as repaired_sha256
from (select distinct conv_id from conversations) i
left join k on k.conv_id is not distinct from i.conv_id left join e on e.conv_id is not distinct from i.conv_id
"""


def op12_stripe_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
with p as (select coalesce(lang, 'und') as lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^ 	]+') as w from p),
g as (select lang, unnest(w) as phrase, 1 as k from w
  union all select lang, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]), 2 from w
  union all select lang, unnest([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)]), 3 from w),
f as (select lang, phrase, k, count(*) as c from g group by all),
t as (select lang, sum(c)::bigint as n from f where k = 1 group by lang),
c as (select lang, phrase, k, c as a, string_split(phrase, ' ') as w from f where k > 1 and c >= 10),
i as (select lang, phrase, max(a) as most from (
    select lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) as phrase, a from c where k = 3) group by all),
s as (select lang, phrase, a, w, k, unnest(range(1, k)) as cut from c left join i using (lang, phrase)
  where most is null or 100 * most < 50 * a),
x as (select s.lang, s.phrase, a, cut, l.c as l, r.c as r, (1000000::hugeint * a * a // (l.c::hugeint * r.c))::bigint as score
  from s join f l on l.lang = s.lang and l.phrase = array_to_string(w[1:cut], ' ')
    join f r on r.lang = s.lang and r.phrase = array_to_string(w[cut + 1:], ' ')),
b as (select * from x qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
q as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from b)
select lang, rank, phrase, a, l, r, n, score from q join t using (lang) where rank <= 2000
"""


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licences(table(spark, sf_dir, "documents")).drop("spans")


QUERIES = {
    f.__name__: f
    for f in (
        op1_repeated_passages,
        op2_sentencepiece_spans,
        op3_redirect_equivalence,
        op4_quotation_links,
        op5_bit_sliced_simhash,
        op6_warc_merged_index,
        op7_spaced_seed_decontamination,
        op8_adaptive_quality,
        op9_seekable_token_frames,
        op10_stupid_backoff,
        op11_conversation_repair,
        op12_stripe_collocations,
        op13_license_scan,
    )
}
ORACLE = {
    "op1_repeated_passages": OP1_SQL,
    "op3_redirect_equivalence": OP3_SQL,
    "op6_warc_merged_index": OP6_SQL,
    "op7_spaced_seed_decontamination": OP7_SQL,
    "op8_adaptive_quality": OP8_SQL,
    "op10_stupid_backoff": OP10_SQL,
    "op11_conversation_repair": OP11_SQL,
    "op12_stripe_collocations": OP12_SQL,
}
