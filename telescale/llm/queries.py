"""The operators of this package as queries over the test tables, by name, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telescale.llm import (
    chat, decontaminate, language, merkle, pieces, quality, repair, rules, secrets, simhash, substring, toxicity, url_lists,
)
from telescale.llm.texts import held_out

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


#: Words of a text between white space, as SQL.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_secrets(spark, sf):
    docs = table(spark, sf, "documents")
    return secrets.secret_scan(docs, identifiers=secrets.learn_identifiers(docs))


@query
def op2_url_lists(spark, sf):
    """The tables hold neither fetch days nor lists: both are derived from all pages, by page_id."""
    pages, host = table(spark, sf, "pages"), url_lists.host_of(F.col("url"))
    key = F.col("page_id")
    captures = pages.select("page_id", "url", (key * 37 % 730).alias("day"))
    entries = pages.select(
        F.element_at(F.array(*map(F.lit, ("ads", "adult", "malware", "spam"))), (key % 4 + 1).cast("int")).alias("list"),
        F.when(key % 8 < 4, host).otherwise(F.regexp_replace(host, r"^[^.]*\.", "")).alias("domain"),
        (key * 101 % 730).alias("day"), (key % 3 != 0).alias("added"),
    )
    return url_lists.judge(captures, entries)


ORACLE["op2_url_lists"] = r"""
with p as (
  select page_id, url, page_id * 37 % 730 as day,
         nullif(rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '.'), '') as host
  from pages
), daily as (
  select (['ads', 'adult', 'malware', 'spam'])[page_id % 4 + 1] as list,
         case when page_id % 8 < 4 then host else regexp_replace(host, '^[^.]*\.', '') end as domain,
         page_id * 101 % 730 as since, max(page_id % 3 <> 0) as added
  from p where host is not null group by 1, 2, 3
), changed as (
  select * from (select *, lag(added, 1, false) over (partition by list, domain order by since) as was from daily)
  where added <> was
), spans as (
  select list, domain, since, next as until
  from (select *, lead(since) over (partition by list, domain order by since) as next from changed) where added
), met as (
  select distinct p.page_id, p.url, p.day, s.list
  from p join spans s on (p.host = s.domain or (s.domain like '%.%' and p.host like '%.' || s.domain))
                     and s.since <= p.day and (s.until is null or p.day < s.until)
), listed as (
  select page_id, url, day, string_agg(list, ',' order by list) as lists from met group by 1, 2, 3
)
select p.page_id, p.url, p.day, p.host, coalesce(l.lists, '') as lists, coalesce(l.lists, '') <> '' as blocked
from (select distinct * from p) p left join listed l
  on p.page_id = l.page_id and p.url is not distinct from l.url and p.day = l.day
"""


@query
def op3_substring(spark, sf):
    left = substring.remove_repeats(table(spark, sf, "documents"))
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE["op3_substring"] = f"""
with d as (select doc_id, {WORDS} as w from documents),
t as (select doc_id, unnest(range(1, len(w) - 11)) as k, w from d),
windows as (select doc_id, k, array_to_string(w[k:k + 12], ' ') as said from t),
firsts as (select said, min(doc_id) as first_id from windows group by said),
gone as (
  select distinct doc_id, unnest(range(k, k + 13)) as place
  from windows join firsts using (said) where first_id < doc_id),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as place from d),
kept as (
  select doc_id, string_agg(word, ' ' order by place) as said, count(*) as n
  from words anti join gone using (doc_id, place) group by doc_id)
select d.doc_id, len(d.w) as n_words, len(d.w) - coalesce(k.n, 0) as n_removed, sha256(coalesce(k.said, '')) as kept_sha256
from d left join kept k using (doc_id)
"""


@query
def op4_simhash(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query
def op5_language(spark, sf):
    docs = table(spark, sf, "documents")
    found = language.identify(docs, language.fit(language.learning_rows(docs)))
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score", "rejected")


@query
def op6_decontaminate(spark, sf):
    return decontaminate.decontaminate(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BENCHMARK_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE["op6_decontaminate"] = f"""
with d as (select doc_id, {_BENCHMARK_WORDS} as w from documents),
i as (select cast(item_id as varchar) as item, {_BENCHMARK_WORDS} as w from benchmark),
sized as (select item, w, least(13, len(w)) as n from i where len(w) > 0),
placed as (select item, w, n, unnest(range(1, len(w) - n + 2)) as k from sized),
windows as (select distinct item, n, array_to_string(w[k:k + n - 1], ' ') as said from placed),
asked as (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k from d, (select distinct n from windows)),
hits as (
  select doc_id, k, n, item from (select doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') as said from asked)
  join windows using (n, said)),
hit_words as (select doc_id, count(distinct place) as n from (
  select doc_id, unnest(range(k, k + n)) as place from hits) group by doc_id),
items as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as said
          from (select distinct doc_id, item from hits) group by doc_id)
select d.doc_id, len(d.w) as n_words, coalesce(h.n, 0) as n_hit, coalesce(i.n, 0) as n_items,
       sha256(coalesce(i.said, '')) as items_sha256, coalesce(h.n, 0) > 0 and 20 * coalesce(h.n, 0) >= len(d.w) as contaminated
from d left join hit_words h using (doc_id) left join items i using (doc_id)
"""


@query
def op7_pieces(spark, sf):
    model = pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))
    return pieces.round_trip(table(spark, sf, "documents"), model)


@query
def op8_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    found = toxicity.toxicity(docs, toxicity.fit(toxicity.learning_rows(docs), table(spark, sf, "labels")))
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


@query
def op9_quality(spark, sf):
    return quality.quality(table(spark, sf, "documents"))


ORACLE["op9_quality"] = rf"""
with d as (
  select doc_id, {WORDS} as w, coalesce(text, '') as text,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
placed as (select doc_id, w, unnest(range(1, len(w) - 1)) as k from d),
windows as (select doc_id, k, array_to_string(w[k:k + 2], ' ') as said from placed),
twice as (select *, count(*) over (partition by doc_id, said) as n from windows),
repeated as (select doc_id, count(distinct place) as n from (
  select doc_id, unnest(range(k, k + 3)) as place from twice where n > 1) group by doc_id),
commonest as (
  select doc_id, max(n) as n from (
    select doc_id, word, count(*) as n from (select doc_id, unnest(w) as word from d) group by doc_id, word) group by doc_id),
m as (
  select d.doc_id, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, len(lines) - len(list_distinct(lines)) as n_dup_lines,
         coalesce(r.n, 0) as n_repeat_words, len(lines) as n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '\pL'))) as lettered,
         len(regexp_extract_all(text, '[A-Z]')) as n_capitals, coalesce(c.n, 0) as n_commonest
  from d left join repeated r using (doc_id) left join commonest c using (doc_id)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or word_chars not between 2 * n_words and 15 * n_words or 4 * n_symbols > n_words
            or 10 * n_dup_lines > 3 * n_lines or 5 * lettered < 3 * n_words or 2 * n_capitals > word_chars
            or 3 * n_commonest > n_words) as kept
from b
"""


@query
def op10_chat(spark, sf):
    return chat.format_conversations(table(spark, sf, "conversations"))


ORACLE["op10_chat"] = r"""
with t as (
  select conv_id, role, text, row_number() over (
    partition by conv_id order by turn nulls first, role nulls first, text nulls first) as n
  from conversations where conv_id is not null
), upto as (
  select conv_id, n, max(n) over (partition by conv_id) as turns,
         string_agg(coalesce('r' || role, '') || chr(31) || coalesce('t' || text, ''), chr(30)) over (
           partition by conv_id order by n rows between unbounded preceding and current row) as said
  from t
), whole as (
  select said, min(conv_id) as conv_id, count(*) as n_snapshots, max(turns) as n_turns
  from upto where n = turns group by said
), kept as (
  select * from whole where said not in (select said from upto where n < turns)
)
select k.conv_id, k.n_turns, k.n_snapshots, string_agg(
         '<|' || coalesce(t.role, '') || '|>' || chr(10) || coalesce(t.text, '') || chr(10) || '<|end|>' || chr(10),
         '' order by t.n) as rendered
from kept k join t using (conv_id) group by all
"""


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text as SQL, bit by bit."""
    return f"""xor(4294967295, list_reduce(
      list_concat([4294967295::bigint], list_transform(string_split({text}, ''), lambda c: ascii(c)::bigint)),
      lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))))"""


@query
def op11_repair(spark, sf):
    conversations = table(spark, sf, "conversations")
    return repair.repair(repair.damaged(conversations), conversations)


_KIND = _crc32("coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' ')")
ORACLE["op11_repair"] = rf"""
with recursive d as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, {_KIND} % 20 as kind from conversations),
damaged as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text,
         unnest(case when kind = 3 then [0, 1] else [0] end) as copy
  from d where kind <> 0),
placed as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as n from damaged),
marked as (
  select *, left(role, 1) as initial,
         case when not regexp_matches(text, '[^ 	-
]') then 'blank'
              when row_number() over (partition by conv_id, role, text order by n) > 1 then 'duplicate'
              when not regexp_matches(text, '[.!?][ 	-
]*$') then 'truncated' end as fault,
         lag(left(role, 1)) over (partition by conv_id order by n) || left(role, 1) as two
  from placed),
counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
         count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (two is not null and two not in ('su', 'ua', 'au')) as illegal, count(*) as n
  from marked group by conv_id),
inserts(a, cost, audit, b, said) as (
  values (0, 0, '', 0, null), (1, 0, '', 1, null), (2, 0, '', 2, null), (3, 0, '', 3, null), (0, 2, 'I', 2, 'user:'),
         (1, 2, 'I', 2, 'user:'), (2, 2, 'I', 3, 'assistant:'), (3, 2, 'I', 2, 'user:'),
         (0, 4, 'II', 3, 'user:' || chr(10) || 'assistant:'), (1, 4, 'II', 3, 'user:' || chr(10) || 'assistant:')),
next(a, role, b) as (values (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
kept(a, initial, b) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
edits as (
  select conv_id, n, a, a as b, 3 as cost, 'D' as audit, null as said from marked, (select distinct a from next)
  union all
  select conv_id, n, a, b, (fault is not null)::int, 'K', role || ':' || text from marked join kept using (initial)
  where coalesce(fault, '') not in ('blank', 'duplicate')
  union all
  select conv_id, n, a, b, 2 + (fault is not null)::int, 'R', next.role || ':' || text from marked, next
  where coalesce(fault, '') not in ('blank', 'duplicate')),
best(conv_id, n, a, x) as (
  select conv_id, 0::bigint, 0, {{'cost': 0, 'audit': '', 'said': null::varchar}} from counts
  union all
  select p.conv_id, p.n + 1, e.b, min({{'cost': p.x.cost + i.cost + e.cost, 'audit': p.x.audit || i.audit || e.audit,
         'said': nullif(concat_ws(chr(10), p.x.said, i.said, e.said), '')}})
  from best p join inserts i on p.a = i.a
  join edits e on e.conv_id is not distinct from p.conv_id and e.n = p.n + 1 and e.a = i.b
  group by p.conv_id, p.n, e.b),
solved as (
  select c.conv_id, min({{'cost': x.cost + i.cost, 'audit': x.audit || i.audit, 'said': concat_ws(chr(10), x.said, i.said)}}) as x
  from best p join counts c on p.conv_id is not distinct from c.conv_id and p.n = c.n
  join inserts i on p.a = i.a where i.b in (0, 3) group by c.conv_id)
select o.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(x.cost, 0)::bigint as cost,
       coalesce(x.audit, '') as audit, sha256(coalesce(x.said, '')) as repaired_sha256
from (select distinct conv_id from conversations) o
left join counts c on c.conv_id is not distinct from o.conv_id left join solved s on s.conv_id is not distinct from o.conv_id
"""


@query
def op12_rules(spark, sf):
    docs = table(spark, sf, "documents")
    found = rules.score(docs, rules.fit(rules.learning_rows(docs), table(spark, sf, "labels")))
    return found.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


@query
def op13_manifest(spark, sf):
    return merkle.verify_documents(table(spark, sf, "documents"), tampered=held_out(5, 0))


_FIELD = "case when {0} is null then '-' else strlen(cast({0} as varchar)) || ':' || {0} end"
_HEAD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_CHANGED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE["op13_manifest"] = f"""
with recursive d as (
  select doc_id, coalesce('s' || source, '') as tree, sha256({_HEAD} || {_FIELD.format("text")}) as leaf,
         sha256({_HEAD} || {_FIELD.format(_CHANGED)}) as changed,
         coalesce({_crc32("cast(doc_id as varchar)")} % 5 = 0, false) as tampered from documents),
leaves as (
  select doc_id, tree, leaf, case when tampered then changed else leaf end as claimed,
         row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as i, count(*) over (partition by tree) as n
  from d),
nodes(tree, level, i, h, n) as (
  select tree, 0, i, leaf, n from leaves
  union all
  select tree, level + 1, i >> 4, sha256(string_agg(h, '' order by i)), (any_value(n) + 15) >> 4
  from nodes where n > 1 group by tree, level, i >> 4),
subroots as (
  select tree, h as subroot, row_number() over (order by tree) - 1 as i, count(*) over () as n from nodes where n = 1),
upper_nodes(level, i, h, n) as (
  select 0, i, subroot, n from subroots
  union all
  select level + 1, i >> 4, sha256(string_agg(h, '' order by i)), (any_value(n) + 15) >> 4
  from upper_nodes where n > 1 group by level, i >> 4),
beside as (
  select l.tree, l.i, u.level, coalesce(string_agg(u.h, '' order by u.i) filter (u.i < l.i >> (4 * u.level)), '') as before,
         coalesce(string_agg(u.h, '' order by u.i) filter (u.i > l.i >> (4 * u.level)), '') as behind
  from leaves l join nodes u on u.tree = l.tree and u.n > 1 and u.i >> 4 = l.i >> (4 * u.level + 4)
  group by l.tree, l.i, u.level),
upper_beside as (
  select s.tree, u.level, coalesce(string_agg(u.h, '' order by u.i) filter (u.i < s.i >> (4 * u.level)), '') as before,
         coalesce(string_agg(u.h, '' order by u.i) filter (u.i > s.i >> (4 * u.level)), '') as behind
  from subroots s join upper_nodes u on u.n > 1 and u.i >> 4 = s.i >> (4 * u.level + 4)
  group by s.tree, u.level),
steps as (
  select *, row_number() over (partition by tree, i order by level) as k from (
    select * from beside union all
    select l.tree, l.i, 100 + u.level, u.before, u.behind from leaves l join upper_beside u using (tree))),
folded(tree, i, k, h) as (
  select tree, i, 0, claimed from leaves
  union all
  select f.tree, f.i, f.k + 1, sha256(s.before || f.h || s.behind)
  from folded f join steps s on s.tree = f.tree and s.i = f.i and s.k = f.k + 1),
proofs as (select tree, i, max(k) as k, string_agg(before || behind, '' order by k) as said from steps group by tree, i),
top as (select h as root from upper_nodes where n = 1)
select l.doc_id, l.leaf, s.subroot, top.root, sha256(coalesce(p.said, '')) as proof_sha256, f.h as folded_root,
       f.h = top.root as verified
from leaves l join subroots s using (tree) cross join top left join proofs p on p.tree = l.tree and p.i = l.i
join folded f on f.tree = l.tree and f.i = l.i and f.k = coalesce(p.k, 0)
"""
