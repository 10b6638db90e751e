"""DuckDB SQL for those queries of this subpackage that SQL can express."""

from __future__ import annotations

from sondeframe.llm.quality import RULES, STOP_WORDS

_WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_STOP = ", ".join(f"'{w}'" for w in sorted({w for v in STOP_WORDS.values() for w in v.split()}))
_MEASURES = {
    "mean_word_length": "case when n_words > 0 then word_chars / n_words else 0 end", "symbol_ratio": "case when word_chars > 0 then n_symbols / word_chars else 0 end",
    "stop_ratio": "case when n_words > 0 then n_stop_words / n_words else 0 end", "dup_line_ratio": "case when n_lines > 0 then n_dup_lines / n_lines else 0 end",
}


def _rule(measure: str, low: float | None, high: float | None, least: int) -> str:
    value = _MEASURES.get(measure, measure)
    bounds = [f"{value} >= {low}"] * (low is not None) + [f"{value} <= {high}"] * (high is not None)
    return f"(n_words < {least} or ({' and '.join(bounds) or 'true'}))"


_KEPT = " and ".join(_rule(*r[1:]) for r in RULES)

OP9 = rf"""
with d as (select doc_id, coalesce(text, '') t from documents),
w as (select doc_id, t, {_WORDS.format("t")} ws from d),
p as (select doc_id, unnest(ws) word, generate_subscripts(ws, 1) i from w),
v as (select doc_id, i, word || ' ' || lead(word, 1) over o || ' ' || lead(word, 2) over o || ' ' || lead(word, 3) over o || ' ' || lead(word, 4) over o win from p window o as (partition by doc_id order by i)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, win) n from v where win is not null) where n > 1),
c as (select doc_id, count(distinct i + k) n_repeat_words from r, (select unnest([0, 1, 2, 3, 4]) k) group by 1),
l as (select doc_id, count(*) n_lines, count(*) - count(distinct line) n_dup_lines from (select doc_id, unnest(string_split(t, chr(10))) line from d) where regexp_matches(line, '[^\x20\x09-\x0D]') group by 1),
s as (select doc_id, sum(length(word)) word_chars, count(*) filter (lower(word) in ({_STOP})) n_stop_words from p group by 1),
q as (select w.doc_id, cast(len(ws) as bigint) n_words, cast(coalesce(word_chars, 0) as bigint) word_chars, cast(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as bigint) n_symbols,
 cast(coalesce(n_dup_lines, 0) as bigint) n_dup_lines, cast(coalesce(n_repeat_words, 0) as bigint) n_repeat_words, cast(coalesce(n_lines, 0) as bigint) n_lines, cast(coalesce(n_stop_words, 0) as bigint) n_stop_words
 from w left join c using (doc_id) left join l using (doc_id) left join s using (doc_id)),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words base_failed from q)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and {_KEPT} kept, n_lines, n_stop_words from b"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + cast((cast('0x' || substr(h, {1 + 10 * g}, 10) as bigint) >> {35 - 5 * j}) & 31 as int), 1)" for g in range(4) for j in range(8)
)
OP10 = f"""
with d as (select page_id, coalesce(html, '') b, sha1(coalesce(html, '')) h, min(page_id) over (partition by coalesce(html, '')) f from pages)
select page_id, cast(octet_length(encode(b)) as bigint) payload_bytes, {_BASE32} payload_digest, case when f = page_id then 'response' else 'revisit' end record_type, case when f <> page_id then f end refers_to from d"""

_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP8 = rf"""
with recursive w as materialized (select doc_id, {_WORDS.format(f"translate(coalesce(text, ''), '{_UP}', '{_LOW}')")} ws from documents),
s as materialized (select distinct doc_id, array_to_string(list_slice(ws, i, i + 2), ' ') x from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 1) + 1)) i from w where len(ws) > 0)),
n as materialized (select doc_id, count(*) n from s group by 1),
e as materialized (select a, b from (select p.doc_id a, q.doc_id b, count(*) i from s p join s q using (x) where p.doc_id <> q.doc_id group by 1, 2)
 join n na on na.doc_id = a join n nb on nb.doc_id = b where 100 * i >= 85 * (na.n + nb.n - i)),
r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a)
select w.doc_id, cast(coalesce(n.n, 0) as bigint) n_shingles, least(w.doc_id, m) component_id, least(w.doc_id, m) = w.doc_id kept
 from w left join n using (doc_id) left join (select a, min(b) m from r group by 1) k on k.a = w.doc_id"""

OP13 = r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') t from documents)
select doc_id, min(doc_id) over w keep_id, cast(count(*) over w as bigint) group_size, doc_id = min(doc_id) over w kept, sha256(t) text_sha256 from d window w as (partition by t)"""

OP11 = """
with e as materialized (select vec_id id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end l, list_transform(embedding, lambda x: floor(256 * cast(x as double))) v from embeddings
 where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as materialized (select a.id a, b.id b, a.l = b.l same, cast(list_dot_product(a.v, b.v) as bigint) x from e a join e b on a.id % 50 = 0 and a.id <> b.id),
p as (select a, b, x from (select *, row_number() over (partition by a order by x desc, b) n from s where same) where n <= 5),
r as (select p.a, p.b pos, s.b neg, p.x px, s.x nx, row_number() over (partition by p.a, p.b order by s.x desc, s.b) n from p join s on s.a = p.a and not s.same and 50 * p.x <= 100 * s.x and 100 * s.x <= 95 * p.x)
select a anchor_id, pos positive_id, cast(n as int) "rank", neg negative_id, px positive_score, nx negative_score from r where n <= 3"""
