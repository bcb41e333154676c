"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from pumpguard.llm import collocations, license_scan, lm_score, sharding, spelling, top_k, warc


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def license_sql() -> str:
    known = ", ".join(f"({_text(s)}, {_text(i)})" for i, s in license_scan.SENTENCES.items())
    rules = ", ".join(f"({n}, {_text(r)}, {_text(l)}, {_text(license_scan.rule_pattern(ids))})"
                      for n, (r, l, ids) in enumerate(license_scan.RULES))
    space, ends = "[ \\t\\n\\x0B\\f\\r]", license_scan.ENDS
    return f"""
with known(sentence, id) as (values {known}), rules(n, rule, license, pattern) as (values {rules}),
docs as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
cut as (select r, regexp_replace(regexp_replace(t, '\\n{space}*\\n', chr(1), 'g'), '{ends}', chr(1), 'g') as c
        from docs where regexp_matches(t, {_text(license_scan.CUE)})),
parts as (select r, 1 as by_line, string_split(replace(c, chr(10), chr(1)), chr(1)) as p from cut
          union all select r, 0, string_split(c, chr(1)) from cut),
sentences as (select r, by_line, i, trim(regexp_replace(lower(p[i]), '[^a-z0-9]+', ' ', 'g')) as s
              from (select r, by_line, p, unnest(range(1, len(p) + 1)) as i from parts)),
named as (select r, by_line, i, coalesce(id, case when regexp_matches(s || ' ', {_text(license_scan.COPYRIGHT)})
                 then 'copyright' end) as id
          from sentences left join known on s = sentence),
lists as (select r, by_line, list(id order by i) as ids from named where id is not null group by r, by_line),
best as (select r, arg_max(ids, (len(ids), by_line)) as ids from lists group by r),
hits as (select r, rule, license, n from best, rules
         where regexp_matches(',' || array_to_string(ids, ',') || ',', pattern)),
firsts as (select r, license, min(n) as n from hits group by r, license),
summed as (select r, string_agg(license, ',' order by n) as licenses from firsts group by r),
top as (select r, arg_min(rule, n) as rule, arg_min(license, n) as license from hits group by r)
select doc_id, coalesce(array_to_string(ids, ','), '') as sentence_ids,
       coalesce(len(ids), 0)::bigint as n_sentences, rule, license, coalesce(licenses, '') as licenses
from docs left join best using (r) left join summed using (r) left join top using (r)"""


def sharding_sql() -> str:
    n, seed = sharding.SHARDS, sharding.SEED

    def unit(expr: str) -> str:
        return f"(('0x' || substr(md5({expr}), 1, 13))::bigint / {1 << 52}.0::double)"
    table = "list_transform(range(256), lambda b: list_reduce(list_prepend(b::ubigint, range(8)::ubigint[]), " \
            "lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end))"
    return f"""
with crc_table as materialized (select {table} as entry),
sized as (select doc_id, coalesce(source, chr(1) || 'null') as s, strlen(coalesce(text, '')) + 16 as size,
                 hex(encode(coalesce(text, ''))) as x from documents),
texts as materialized (select x, regexp_extract_all(x, '..') as bytes from (select distinct x from sized)),
crcs as materialized (select x, xor(list_reduce(
            list_prepend(4294967295::ubigint, list_transform(bytes, lambda b: ('0x' || b)::ubigint)),
            lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255)::bigint + 1])), 4294967295::ubigint)::bigint as crc
         from texts, crc_table),
rows as (select doc_id, s, size, crc,
                {unit(f"'{seed}|' || coalesce(doc_id, -1) || '|' || crc")} as h from sized join crcs using (x)),
ranked as (select *, row_number() over (partition by s order by h, doc_id nulls first, crc, size) - 1 as r,
                  count(*) over (partition by s) as n_s, count(*) over () as n from rows),
placed as (select *, row_number() over (order by (r::double + {unit(f"'{seed}|' || s")}) / n_s::double,
                  s, h, doc_id nulls first, crc, size) - 1 as pos from ranked)
select doc_id, size::bigint as size, crc as text_crc32, 'rows' as law,
       ((pos * {n}) // n)::int as shard,
       (pos - (((pos * {n}) // n) * n + {n - 1}) // {n})::bigint as slot,
       null::int as grown_shard, nullif(s, chr(1) || 'null') as stratum
from placed"""


def lm_sql() -> str:
    w = lm_score.WEIGHT
    return f"""
with good as (select doc_id from labels where doc_id is not null group by doc_id
              having min(quality) = 1 and coalesce(max(toxic), 0) = 0),
docs as (select row_number() over () as r, d.doc_id,
                list_filter(regexp_split_to_array(translate(coalesce(text, ''),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'),
                    lambda x: x <> '') as words, g.doc_id is not null as target
         from documents d left join good g on d.doc_id = g.doc_id),
pairs as materialized (select r, target, case when i > 1 then words[i - 1] else '' end as u,
                              coalesce(words[i], '') as v
         from (select r, target, words, unnest(range(1, len(words) + 2)) as i from docs where len(words) > 0)),
counts as (select u, v, count(*) as b, count(*) filter (target) as t from pairs group by u, v),
contexts as (select u, sum(b) as b, sum(t) as t from counts group by u),
totals as (select count(*) as n, sum(b) as b, sum(t) as t from contexts where u <> ''),
differences as materialized (select c.u, c.v,
   {w} * (ln((c.b + 1)::double / (x.b + a.n + 1)::double) - ln((c.t + 1)::double / (x.t + a.n + 1)::double))
   + case when c.u = '' then 0 else {1 - w} * (ln((x.b + 1)::double / (a.b + a.n)::double)
                                               - ln((x.t + 1)::double / (a.t + a.n)::double)) end as d
   from counts c join contexts x using (u) cross join totals a),
sums as (select r, sum(d) as s from pairs join differences using (u, v) group by r)
select doc_id, len(words)::bigint as n_tokens, round(s / len(words), 6) as score,
       coalesce(round(s / len(words), 6) < 0, false) as in_target
from docs left join sums using (r)"""


def warc_sql() -> str:
    return f"""
with rows as (select page_id, url, sha256(coalesce(html, '')) as digest, strlen(coalesce(html, '')) as n,
                     row_number() over (partition by sha256(coalesce(html, ''))
                                        order by page_id nulls last, url nulls last) as k from pages),
firsts as (select digest, page_id as first from rows where k = 1 and n >= {warc.MIN_REVISIT_BYTES})
select page_id, n::bigint as payload_bytes, digest as payload_digest,
       case when firsts.digest is not null and k > 1 then 'revisit' else 'response' end as record_type,
       case when firsts.digest is not null and k > 1 then first end as refers_to
from rows left join firsts using (digest)"""


def top_k_sql() -> str:
    return f"""
with vectors as (select row_number() over () as r, vec_id,
                        list_transform(embedding, lambda x: floor({top_k.SCALE} * x::double)::bigint) as v
                 from embeddings where embedding is not null
                 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
pairs as (select q.r, q.vec_id as query_id, c.r as other, c.vec_id,
                 coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::bigint as score
          from vectors q join vectors c on q.vec_id % {top_k.QUERY_STEP} = 0 and q.r <> c.r)
select query_id, row_number() over (partition by r order by score desc, vec_id nulls last, other)::int as rank, vec_id, score
from pairs qualify rank <= {top_k.K}"""


def spelling_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    entry = "list_transform(range(256), lambda b: list_reduce(list_prepend(b::ubigint, range(8)::ubigint[]), " \
            "lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end))"
    return f"""
with recursive crc_table as materialized (select {entry} as entry),
runs as (select coalesce(doc_id::varchar, '') as doc, unnest(regexp_extract_all(translate(coalesce(text, ''),
                '{upper}', '{lower}'), '[a-z\u00C0-\u00FF]+')) as run from documents),
counted as (select doc, run, count(*) as n from runs where length(run) >= {spelling.MIN_LENGTH} group by doc, run),
hashed as (select run, n, xor(list_reduce(list_prepend(4294967295::ubigint,
                list_transform(regexp_extract_all(hex(encode(doc || ':' || run)), '..'), lambda b: ('0x' || b)::ubigint)),
                lambda c, b: xor(c >> 8, entry[(xor(c, b) & 255)::bigint + 1])), 4294967295::ubigint)::bigint as h
           from counted, crc_table),
shortened as (select case when h % {spelling.DELETE_MODULUS} = 0 then
                     substring(run, 1, (h % length(run))::int) || substring(run, (h % length(run))::int + 2) else run end as word, n
              from hashed),
words as materialized (select word, sum(n)::bigint as n from shortened where length(word) >= {spelling.MIN_LENGTH}
                       group by word having sum(n) >= {spelling.MIN_COUNT}),
without as materialized (select word, i, substring(word, 1, i - 1) || substring(word, i + 1) as left_over
            from (select word, unnest(range(1, length(word) + 1)) as i from words)),
near as materialized (
    select a.word as a, b.word as b from without a join without b
        on a.left_over = b.left_over and a.i = b.i and a.word <> b.word
    union select word, left_over from without where left_over in (select word from words)
    union select left_over, word from without where left_over in (select word from words)),
ranked as (select a, b, n, count(*) over (partition by a) as n_near,
                  row_number() over (partition by a order by n desc, b) as k from near join words on b = word),
forms as materialized (select w.word, w.n, coalesce(r.n_near, 0)::bigint as n_near,
                  case when r.n >= {spelling.FORM_RATIO} * w.n then r.b end as form,
                  case when r.n >= {spelling.FORM_RATIO} * w.n then r.n end as form_n
          from words w left join ranked r on w.word = r.a and r.k = 1),
steps as (select word, coalesce(form, word) as root, 0 as depth from forms
          union all select s.word, f.form, depth + 1 from steps s join forms f on s.root = f.word where f.form is not null),
roots as (select word, arg_max(root, depth) as root from steps group by word)
select word, form, root, n, n_near, form_n from forms join roots using (word)"""


def collocations_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    n, least = collocations.MOST_WORDS, collocations.MIN_COUNT
    phrases = " union all ".join(
        f"select lang, array_to_string(words[i:i + {k - 1}], ' ') as phrase, {k} as k, count(*) as f "
        f"from (select lang, words, unnest(range(1, len(words) - {k - 2})) as i from pieces) group by lang, phrase "
        + ("" if k == 1 else f"having count(*) >= {least}") for k in range(1, n + 1))
    return f"""
with texts as (select coalesce(lang, '{collocations.NO_LANG}') as lang, translate(coalesce(text, ''), '{upper}', '{lower}') as t
               from documents),
cut as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as piece from texts),
pieces as materialized (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') as words from cut),
counts as materialized ({phrases}),
totals as (select lang, sum(f)::bigint as n from counts where k = 1 group by lang),
candidates as materialized (select lang, phrase, k, f as a, string_split(phrase, ' ') as words from counts where k > 1),
cuts as (select c.lang, c.phrase, c.a, j, l.f as l, r.f as r, n,
                ((1000::hugeint * c.a * n) // (l.f::hugeint * r.f))::bigint as score
         from (select *, unnest(range(1, k)) as j from candidates) c join totals using (lang)
         join counts l on l.lang = c.lang and l.phrase = array_to_string(words[1:j], ' ')
         join counts r on r.lang = c.lang and r.phrase = array_to_string(words[j + 1:], ' ')),
weakest as (select * from cuts qualify row_number() over (partition by lang, phrase order by score, j) = 1),
inside as (select lang, array_to_string(words[i:i + m - 1], ' ') as phrase, max(a) as longer
           from (select *, unnest(range(1, k - m + 2)) as i from (select *, unnest(range(2, k)) as m from candidates))
           group by 1, 2),
kept as (select w.* from weakest w left join inside i on w.lang = i.lang and w.phrase = i.phrase
         where i.longer is null or 100 * i.longer < 100 * w.a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase)::bigint as rank, phrase,
       a, l, r, n, score from kept qualify rank <= {collocations.TOP}"""


ORACLES = {"op1_license_scan": license_sql(), "op2_sharding": sharding_sql(),
           "op6_lm_score": lm_sql(), "op8_warc": warc_sql(), "op11_top_k": top_k_sql(),
           "op12_spelling_variants": spelling_sql(), "op13_collocations": collocations_sql()}
