"""DuckDB SQL of the queries that SQL can express, written apart from the operators.

Only fixed values (word lists, limits) are the operators' own.
"""

from __future__ import annotations

from ledgerday.llm.quality_rules import (
    COMMON_WORDS, MAX_CHAR_DISTANCE, MAX_WORD_DISTANCE, MIN_COMMON, MIN_WORDS, UNIT,
)

_BLANKS = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_N_COMMON = len(COMMON_WORDS["en"]) + 1


def _split(text: str) -> str:
    return f"case when trim({text}, {_BLANKS}) = '' then [] else string_split_regex(trim({text}, {_BLANKS}), '[ \\t-\\r]+') end"


def _distance(p: str, q: str) -> str:
    """The Jensen-Shannon distance of two lists of counts; 0 where either is empty."""
    def half(x: str, other: str) -> str:
        return f"(case when {x} > 0 then {x} * log2({x} / (({x} + {other}) / 2)) else 0 end)"

    a, b = f"(z[1] / list_sum({p})::double)", f"(z[2] / list_sum({q})::double)"
    terms = f"[{half(a, b)} + {half(b, a)} for z in list_zip({p}, {q})]"
    return f"(case when list_sum({p}) > 0 and list_sum({q}) > 0 then sqrt(greatest(list_sum({terms}) / 2, 0)) else 0 end)"


def _references(rows: str, where: str) -> str:
    def total(column: str, size: int) -> str:
        return "[" + ", ".join(f"coalesce(sum({column}[{i + 1}]), 0)" for i in range(size)) + "]"

    return f"""select lang, {total('chars', 5)} as ref_chars, {total('common', _N_COMMON)} as ref_common from {rows}
    where not base_failed and n_words >= {MIN_WORDS} and {where} group by lang"""


def _judged(rows: str, references: str) -> str:
    total = "list_sum(ref_common)"
    return f"""select m.*, coalesce({_distance('chars', 'ref_chars')}, 0) as char_distance,
        case when len(common) > 0 then coalesce({_distance('common', 'ref_common')}, 0) else 0 end as word_distance,
        coalesce(n_words * (({total} - ref_common[{_N_COMMON}]) / greatest({total}, 1)::double) >= {MIN_COMMON}, false) as words_judged,
        n_words >= {MIN_WORDS} and (char_distance > {MAX_CHAR_DISTANCE} or (words_judged and word_distance > {MAX_WORD_DISTANCE})) as unlike
    from {rows} m left join {references} r on m.lang is not distinct from r.lang"""


def _common(lang: str, listed: list[str]) -> str:
    shares = [f"round(len([x for x in lw if x = '{w}'])::double * {UNIT} / greatest(n_words, 1))::bigint" for w in listed]
    hits = f"len([x for x in lw if x in ({', '.join(repr(w) for w in listed)})])"
    return f"when '{lang}' then [{', '.join(shares)}, round((n_words - {hits})::double * {UNIT} / greatest(n_words, 1))::bigint]"


_QUALITY = f"""
with texts as (
    select row_number() over () as r, doc_id, lower(lang) as lang, coalesce(text, '') as text from documents
), split as (
    select *, {_split('text')} as ws, {_split('lower(text)')} as lw,
        [x for x in string_split(text, chr(10)) if trim(x, {_BLANKS}) <> ''] as lines
    from texts
), windows as (
    select r, i, count(*) over (partition by r, ws[i : i + 4]) as n
    from (select r, ws, unnest(range(1, len(ws) - 3)) as i from split)
), repeats as (
    select r, count(distinct p) as n_repeat_words from (select r, unnest(range(i, i + 5)) as p from windows where n > 1) group by r
), counts as (
    select s.r, doc_id, lang, lw, length(text) as n_chars, len(ws)::bigint as n_words,
        coalesce(list_sum([length(w) for w in ws]), 0)::bigint as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
        length(text) - length(regexp_replace(text, '\\p{{Ll}}+', '', 'g')) as n_lower,
        length(text) - length(regexp_replace(text, '\\p{{Lu}}+', '', 'g')) as n_upper
    from split s left join repeats using (r)
), measured as (
    select r, doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
        [case when n_chars > 0 then round(c::double * {UNIT} / n_chars)::bigint else 0 end for c in
            [n_lower, n_upper, n_symbols, n_chars - word_chars, n_chars - (n_lower + n_upper + n_symbols + n_chars - word_chars)]] as chars,
        case lang {' '.join(_common(k, v) for k, v in COMMON_WORDS.items())} else [] end as common
    from counts
), first_references as (
    {_references('measured', 'true')}
), first_judged as (
    {_judged('measured', 'first_references')}
), last_references as (
    {_references('first_judged', 'not unlike')}
), judged as (
    {_judged('measured', 'last_references')}
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not unlike as kept,
    round(char_distance, 6) as char_distance, round(word_distance, 6) as word_distance
from judged"""

ORACLE_SQL: dict[str, str] = {
    "op4_quality_rules": _QUALITY,
    "op12_hard_negatives": """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        [floor(256 * x::double) for x in embedding] as v
    from embeddings
    where label is not null and embedding is not null
        and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scores as (
    select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id, list_inner_product(a.v, b.v)::bigint as score
    from rows a join rows b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
), positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scores where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id, row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::int as rank,
    vec_id as negative_id, positive_score, score as negative_score
from positives join scores using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3""",
    "op13_chat_formatting": r"""
with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
    sum(length('### ' || regexp_replace(role, '([\\#<:])', '\\\1', 'g') || ': '
        || regexp_replace(text, '([\\#<])', '\\\1', 'g') || ' </turn>' || chr(10)))::bigint as formatted_chars
from turns group by conv_id""",
}
