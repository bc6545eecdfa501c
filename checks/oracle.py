"""SQL counterparts of the registered queries, for DuckDB over the same tables.

Each statement is a chain of common table expressions and a final select. The chain is
relational where the Spark side works with array expressions: spans are rows, positions
are window sums, and the text is put together by ordered string aggregation.
"""

from __future__ import annotations

import re

from checks.examples import EXAMPLES, values_sql
from msgloom import constants as C
from msgloom.operators.entities import RULES
from msgloom.operators.features import FLAGS, TOKEN_PATTERN

from checks.fixtures import EVENT_LABELS, SCORER_WORDS


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strings(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def h(expr: str) -> str:
    return f"cast('0x' || substr(md5(cast({expr} as varchar)), 1, 8) as bigint)"


def pick(labels, index: str) -> str:
    return f"({strings(labels)})[cast({index} as integer) + 1]"


def sub(expr: str, pattern: str, by: str) -> str:
    return f"regexp_replace({expr}, {q(pattern)}, {q(by)}, 'g')"


def has(expr: str, pattern: str) -> str:
    return f"regexp_matches({expr}, {q(pattern)})"


def template(n: str, price: str, customer: str, key: str) -> str:
    texts = [
        f"'Where is my order ORD-' || (10000 + {n} % 90000) || '?'",
        f"'Please send invoice INV-' || (10000 + {n} % 90000) || ' to user' || ({n} % 97) || '@mail.example.com'",
        f"'I want to see bill #' || ({n} % 100000)",
        f"'Refund $' || ({n} % 1500) || '.50 please'",
        f"'I bought it ' || (({n} // 12) % 30) || ' months ago'",
        "'Open a gold  account'",
        "'Deliver to Kent in june'",
        f"'Call me at +1 555-201-' || (1000 + {n} % 9000)",
        f"'Visit https://shop.example.com/' || {n} || ' now'",
        "'Cancel my card 4111 1111 1111 1111'",
        f"'This is Customer#' || lpad(cast({customer} as varchar), 9, '0') || ' about order ' || {key}"
        f" || ' worth $' || {price} || ', last month'",
        f"'Transfer to GB82 WEST 1234 5698 7654 32 for purchase ' || {key}"
        f" || ', licence D1234567, account ' || (10000000 + {n} % 90000000)",
    ]
    cases = " ".join(f"when {n} % 12 = {i} then {t}" for i, t in enumerate(texts))
    return f"case {cases} end"


WS = C.WHITESPACE
AWS = C.ASCII_WHITESPACE


def strip(e: str) -> str:
    return sub(e, rf"^[{WS}]+|[{WS}]+\z", "")


def collapse(e: str) -> str:
    return f"trim({sub(e, rf'[{AWS}]+', ' ')})"


def clean(e: str) -> str:
    no_urls = sub(f"coalesce({e}, '')", rf"http[^{WS}]+", "")
    return collapse(sub(no_urls, r"[^\x00-\x7F]", " "))


def amount_bin(a: str) -> str:
    edges = C.AMOUNT_BIN_EDGES
    cases = " ".join(
        f"when {a} >= {lo} and {a} < {hi} then '{lo}_{hi}'" for lo, hi in zip(edges, edges[1:])
    )
    return f"case {cases} else '{edges[-1]}_plus' end"


def recency_bin(m: str) -> str:
    edges = C.RECENCY_BIN_EDGES_MONTHS
    cases = " ".join(
        f"when {m} >= {lo} and {m} < {hi} then '{name}'"
        for lo, hi, name in zip(edges, edges[1:], C.RECENCY_BIN_LABELS)
    )
    return f"case {cases} else '{C.RECENCY_BIN_LABELS[-1]}' end"


def parse_amount(e: str) -> str:
    return f"try_cast({sub(e, '[^0-9.-]', '')} as double)"


def date_token(e: str) -> str:
    v = f"lower(trim({e}))"
    words = "|".join(C.NUMBER_WORDS)
    spelled = f"list_position({strings(C.NUMBER_WORDS)}, regexp_extract({v}, {q(rf'({words}) +months? +ago')}, 1))"
    months = f"try_cast(regexp_extract({v}, '([0-9]+) +months? +ago', 1) as double)"
    years = f"12 * try_cast(regexp_extract({v}, '([0-9]+) +years? +ago', 1) as double)"
    month_cases = " ".join(
        f"when {has(v, rf'\b{m}\b')} then '[DATE_MONTH={m}]'" for m in C.MONTH_NAMES
    )
    return f"""case
      when {v} = '' then '[DATE]'
      when {has(v, r'\b(what|when|which|how)\b')} and {has(v, r'\b(hours?|time|when)\b')}
        then '[DATE_TIME_QUESTION]'
      when {has(v, '[0-9]+ +months? +ago')} then '[DATE_REL_BIN=' || {recency_bin(months)} || ']'
      when {has(v, rf'\b({words}) +months? +ago')} then '[DATE_REL_BIN=' || {recency_bin(spelled)} || ']'
      when {has(v, r'\b(last|this) +month\b')} then '[DATE_REL_BIN=31_180days]'
      when {has(v, '[0-9]+ +years? +ago')} then '[DATE_REL_BIN=' || {recency_bin(years)} || ']'
      {month_cases}
      when {has(v, r'\b(19|20)[0-9][0-9]\b')}
        then '[DATE_YEAR=' || regexp_extract({v}, {q(r'\b(19|20)[0-9][0-9]\b')}) || ']'
      when {has(v, '[0-9]{1,4}[/-][0-9]{1,2}[/-][0-9]{1,4}')}
        then '[DATE_ISO=' || regexp_extract({v}, '[0-9]{{1,4}}[/-][0-9]{{1,2}}[/-][0-9]{{1,4}}') || ']'
      when {v} = '2100' then '[DATE_YEAR=2100]'
      else '[DATE]' end"""


def luhn(v: str) -> str:
    d = sub(v, "[^0-9]", "")
    digit = f"cast(substr({d}, cast(length({d}) - i as integer), 1) as integer)"
    return (
        f"list_sum(list_transform(range(0, length({d})), lambda i: "
        f"case when i % 2 = 0 then {digit} when {digit} > 4 then 2 * {digit} - 9 else 2 * {digit} end)) % 10 = 0"
    )


def iban(v: str) -> str:
    compact = f"replace({v}, ' ', '')"
    turned = f"substr({compact}, 5) || substr({compact}, 1, 4)"
    return (
        f"list_reduce(list_transform(string_split({turned}, ''), lambda ch: "
        "case when ch between '0' and '9' then {'v': cast(ord(ch) - 48 as bigint), 'm': 10} "
        "else {'v': cast(ord(ch) - 55 as bigint), 'm': 100} end), "
        "lambda a, b: {'v': (a.v * b.m + b.v) % 97, 'm': b.m}).v % 97 = 1"
    )


def _rule_scan(i: int) -> str:
    rule = RULES[i]
    ph = C.ENTITY_PLACEHOLDERS.get(rule.entity, f"[{rule.entity}]")
    score = "cast(null as double)" if rule.score is None else f"cast({rule.score} as double)"
    p = q(rule.pattern)
    return f"""select row_seq, {i} as rule_no, {q(ph)} as ph, {score} as score,
      regexp_extract_all(text_clean, {p}) as m, regexp_split_to_array(text_clean, {p}) as g
      from cleaned where regexp_matches(text_clean, {p})"""


def placeholder_piece() -> str:
    name = "trim(ph, '[]')"
    v = "trim(value)"
    amount = parse_amount(v)
    hidden = strings(C.REFERENCE_PLACEHOLDERS + C.SENSITIVE_PLACEHOLDERS)
    return f"""case
      when {v} = '' then ph
      when list_contains({strings(C.READABLE_PLACEHOLDERS)}, {name})
        then '[' || {name} || '=' || {sub(f'lower({v})', ' +', '_')} || ']'
      when list_contains({hidden}, {name}) then '[' || {name} || '_PRESENCE]'
      when {name} = 'REFUND_AMOUNT' and {amount} is not null
        then '[REFUND_AMT_BIN=' || {amount_bin(amount)} || ']'
      when {name} in ('DATE', 'DATE_TIME') then {date_token(v)}
      else ph end"""


def any_name(test: str) -> str:
    return f"len(list_filter(names, lambda x: {test})) > 0"


def sanitize(e: str) -> str:
    t = f"trim({sub(f'lower({e})', '[^0-9a-z]+', '_')}, '_')"
    return f"case when {e} is null then '' when {t} = '' then 'UNKNOWN' else upper({t}) end"


def _last(test: str, value: str) -> str:
    return (
        "list_transform(list_filter(list_zip(names, vals), "
        f"lambda p: ({test}) and p[2] <> ''), lambda p: {value})[-1]"
    )


REFUND = "starts_with(p[1], 'REFUND_AMT_BIN') or starts_with(p[1], 'REFUND_AMOUNT') or starts_with(p[1], 'REFUND_AMT')"
DATES = " or ".join(
    f"starts_with(p[1], '{n}')" for n in ("DATE_REL_BIN", "DATE_MONTH", "DATE_YEAR", "DATE_ISO")
)


def word(e: str) -> str:
    return sub(e, "[^0-9A-Z_a-z=]+", "_")


def _tokens() -> str:
    items = [
        "case when account_type <> '' then '[ACCOUNT_TYPE_' || account_type || ']' end",
        f"case when refund_amt_bin <> '' then '[REFUND_AMT_BIN=' || {word('refund_amt_bin')} || ']' end",
        f"case when date_bin <> '' then '[' || {word('date_bin')} || ']' end",
    ] + [f"case when {f} then '[{f.upper()}]' end" for f in FLAGS]
    return "concat_ws(' ', " + ", ".join(items) + ")"


def _entity_value() -> str:
    options = []
    for name in C.GROUP_KEY_PLACEHOLDERS:
        options.append(f"max(case when ph = '[{name}]' then first_value end)")
    return "coalesce(" + ", ".join(options) + ")"


def bucket_split(key: str) -> str:
    draw = f"({h(f'{q(str(C.SEED) + chr(124))} || {key}')} % 10000)"
    return f"case when {draw} < 1500 then 'test' when {draw} < 3000 then 'val' else 'train' end"


def unit(expr: str) -> str:
    return f"(({h(expr)} + 0.5) / 4294967296.0)"


LOGITS10 = ", ".join(
    f"({h(f'vec_id || {q(chr(124) + str(c))}')} % 1000) / 100.0::double + case when label = {c} then 4.0::double else 0.0::double end"
    for c in range(10)
)

SCORER = ", ".join(
    (
        f"case when contains(lower(t), {q(SCORER_WORDS[label])}) then 5.0::double else 0.0::double end"
        if label in SCORER_WORDS
        else "0.0::double"
    )
    + f" + ({h(f't || {q(chr(124) + label)}')} % 100) / 100.0::double"
    for label in C.INTENT_LABELS
)

# Name -> body of a common table expression; later ones use earlier ones.
CTES: dict[str, str] = {
    "docs_n": f"select doc_id, text, {h('text')} as n from documents",
    "orders_n": f"""select o_orderkey, o_custkey, cast(o_totalprice as decimal(15, 2)) as price,
        {h("'ord|' || o_orderkey")} as n from orders""",
    "unlabelled": f"""
        select doc_id * 2 as row_seq, case when n % 12 < 10
          then {template('n', "'1.00'", 'n % 1000', 'n')} || ' ' || text else text end as text
        from docs_n
        union all
        select o_orderkey * 2 + 1, {template('n', 'price', 'o_custkey', 'o_orderkey')} from orders_n""",
    "messages": f"""select row_seq, text, {pick(C.INTENT_LABELS, '(k * k) // 14')} as label
        from (select *, {h("'lab|' || row_seq")} % 14 as k from unlabelled)""",
    "cleaned": f"select row_seq, text as text_raw, label, {clean('text')} as text_clean from messages",
    "scans": " union all ".join(_rule_scan(i) for i in range(len(RULES))),
    "matches": """select row_seq, rule_no, ph, score, unnest(m) as value, unnest(g[1:len(m)]) as gap,
        generate_subscripts(m, 1) as i from scans""",
    "positioned": """select *, sum(length(gap) + length(value)) over
        (partition by row_seq, rule_no order by i) as end_pos from matches""",
    "spans": f"""select row_seq, rule_no, i, ph, score, value,
        cast(end_pos - length(value) as integer) as start_pos, cast(end_pos as integer) as end_pos
        from positioned
        where case when ph = '[CREDIT_CARD]' then {luhn('value')}
                   when ph = '[IBAN]' then {iban('value')}
                   when ph = '[CRYPTO]' then regexp_matches(value, '[A-Za-z]') and regexp_matches(value, '[0-9]')
                   else true end""",
    "candidates": """select row_seq, list({'s': start_pos, 'e': end_pos,
          'kept': [{'s': start_pos, 'e': end_pos, 'ph': ph, 'value': value}]}
          order by start_pos, -coalesce(score, 0), rule_no, i) as l
        from spans where ph <> '[STOP_ENTITY]' group by row_seq""",
    "merged": """select row_seq, list_reduce(l, lambda a, b: case when b.s >= a.e
          then {'s': b.s, 'e': b.e, 'kept': list_concat(a.kept, b.kept)} else a end).kept as kept
        from candidates""",
    "kept": """select row_seq, turn, k.s as s, k.e as e, k.ph as ph, k.value as value
        from (select row_seq, unnest(kept) as k, generate_subscripts(kept, 1) as turn from merged)""",
    "parts": f"""select row_seq, turn, e, lower(trim(substr(text_clean, prev_end + 1, s - prev_end))) as gap,
          {placeholder_piece()} as piece
        from (select *, coalesce(lag(e) over (partition by row_seq order by turn), 0) as prev_end from kept)
        join cleaned using (row_seq)""",
    "bodies": """select row_seq, string_agg(p, ' ' order by turn, o) as body, max(e) as last_end
        from (select row_seq, turn, 0 as o, gap as p, e from parts
              union all select row_seq, turn, 1, piece, e from parts)
        where p <> '' group by row_seq""",
    "normalised": f"""select row_seq, text_raw, label,
          case when row_seq not in (select row_seq from spans) then lower(text_clean)
          else lower({collapse(sub("concat_ws(' ', body, nullif(lower(trim(substr(text_clean, coalesce(last_end, 0) + 1))), ''))",
                                    C.ID_LIKE_PATTERN, ' [ID_PRESENT] '))}) end as text
        from cleaned left join bodies using (row_seq)""",
    "slots": """select row_seq, ph, value, min(turn) as first_turn from kept group by all""",
    "named": f"""select *, list_transform(regexp_extract_all(text, {q(C.PLACEHOLDER_PATTERN)}, 1), lambda x: upper(x)) as names,
          list_transform(regexp_extract_all(text, {q(C.PLACEHOLDER_PATTERN)}, 2), lambda x: coalesce(x, '')) as vals
        from normalised""",
    "flagged": f"""select *,
          {any_name("contains(x, 'ORDER')")} as order_present,
          {any_name("contains(x, 'INVOICE') and not contains(x, 'BILL')")} as invoice_present,
          {any_name("contains(x, 'BILL')")} as bill_present,
          {any_name("contains(x, 'PHONE')")} as phone_present,
          {any_name("contains(x, 'EMAIL')")} as email_present,
          {any_name("contains(x, 'PERSON')")} as person_present,
          {_last("p[1] = 'ACCOUNT_TYPE'", sanitize('p[2]'))} as account_type,
          {_last(REFUND, sub('p[2]', ' +', ''))} as refund_amt_bin,
          {_last(DATES, "p[1] || '=' || p[2]")} as date_bin,
          len(list_filter(list_zip(names, vals), lambda p: not (p[1] = 'ACCOUNT_TYPE' or {REFUND} or {DATES}))) as n_other
        from named""",
    "bodied": f"""select *, lower({collapse(sub('text', C.PLACEHOLDER_PATTERN, ' '))}) as body,
          nullif({_tokens()}, '') as tokens from flagged""",
    "modelled": f"""select *, {collapse(sub(sub("concat_ws(' ', body, coalesce(tokens, ''))", C.LEFTOVER_ID_PATTERN, ' [ID_PRESENT] '), C.LABEL_WORD_PATTERN, ' '))} as text_model
        from bodied""",
    "first_values": """select row_seq, ph, arg_min(value, first_turn) as first_value from slots group by row_seq, ph""",
    "entity_values": f"select row_seq, {_entity_value()} as entity_value from first_values group by row_seq",
    "keyed": """select m.*, nullif(concat_ws('|',
            case when account_type <> '' then 'acct:' || account_type end,
            case when order_present then 'order' end,
            case when invoice_present then 'invoice' end,
            case when bill_present then 'bill' end), '') as presence,
          entity_value
        from modelled m left join entity_values using (row_seq)""",
    "grouped": """select *, md5(coalesce(entity_value, presence, text_model)) as entity_key,
          md5(coalesce(presence, text_model)) as presence_key from keyed""",
    "unique_rows": "select * from grouped qualify row_number() over (partition by text_model order by row_seq) = 1",
    "prepared": f"""select *, entity_key as group_key, dense_rank() over (order by label) - 1 as encoded_label,
          {bucket_split('entity_key')} as split from unique_rows""",
    "logs": f"""select event_id, ts, event_type as pred, actual, confidence,
          case when actual is null then null when actual = event_type then 1 else 0 end as correct
        from (select event_id, ts, event_type, 0.5 + (n % 500) / 1000.0 as confidence,
                case when n % 10 = 0 then null when n % 10 < 8 then event_type
                     else {pick(EVENT_LABELS, '(n // 16) % 5')} end as actual
              from (select *, {h("'act|' || event_id")} as n from events))""",
    "daily": """select strftime(ts, '%Y-%m-%d') as day, intent,
          count(*) filter (role = 'predicted' and correct = 1) as tp,
          count(*) filter (role = 'predicted' and correct = 0) as fp,
          count(*) filter (role = 'actual' and correct = 0) as fn
        from (select ts, pred as intent, 'predicted' as role, correct from logs where pred is not null and correct is not null
              union all
              select ts, actual, 'actual', correct from logs where actual is not null and correct is not null)
        group by all""",
    "logits": f"select vec_id as row_seq, label as true_id, [{LOGITS10}] as z from embeddings",
    "exps": "select row_seq, true_id, list_transform(z, lambda v: exp(v - list_max(z))) as e from logits",
    "soft": "select row_seq, true_id, list_transform(e, lambda v: v / list_sum(e)) as probs from exps",
    "preds": """select *, list_position(probs, list_max(probs)) - 1 as pred_id,
          list_max(probs) as confidence, 'vector ' || row_seq as text from soft""",
    "classes": "select distinct 'class_' || label as label, label as id from embeddings",
    "cells": "select true_id as true_l, pred_id as pred_l, count(*) as n from preds group by all",
    "class_list": "select true_l as label from cells union select pred_l from cells",
    "class_sums": """select label,
          (select coalesce(sum(n), 0) from cells where true_l = label and pred_l = label) as tp,
          (select coalesce(sum(n), 0) from cells where pred_l = label) as n_pred,
          (select coalesce(sum(n), 0) from cells where true_l = label) as support
        from class_list""",
    "scores": """select *, case when p + r = 0 then 0 else 2 * p * r / (p + r) end as f1
        from (select *, case when n_pred = 0 then 0 else tp / n_pred::double end as p,
                case when support = 0 then 0 else tp / support::double end as r from class_sums)""",
    "points": """select true_id, unnest(range(0, 10)) as id, unnest(probs) as score from preds""",
    "curve": """select id, score, count(*) as n_all, count(*) filter (true_id = id) as n_pos from points group by all""",
    "sums": """select id, score, n_all, n_pos,
          sum(n_pos) over (partition by id order by score desc) as tp_at,
          sum(n_all) over (partition by id order by score desc) as all_at,
          sum(n_pos) over (partition by id) as pos
        from curve""",
}


def f1_at(tp: str, taken: str) -> str:
    p = f"(case when {taken} = 0 then 1.0 else {tp} / ({taken})::double end)"
    r = f"({tp} / pos::double)"
    return f"(case when {p} + {r} = 0 then 0 else 2.0 * {p} * {r} / ({p} + {r}) end)"


def best_cte(shift: int) -> str:
    tp, taken = ("tp_at - n_pos", "all_at - n_all") if shift else ("tp_at", "all_at")
    return f"""select id, max(pos) as pos, arg_max(score, (f1, -score)) as score, max(f1) as f1
        from (select *, {f1_at(f'({tp})', f'({taken})')} as f1 from sums where pos > 0) group by id"""


for _shift in (0, 1):
    CTES[f"best{_shift}"] = best_cte(_shift)

CTES |= {
    "limits": "select label, c.id as id, case when b.id is null then 0.75 else greatest(score, 0.0) end as threshold "
    "from classes c left join best1 b on c.id = b.id",
    "load_rows": "select row_seq, text as text_raw, lower(text) as text, label from messages",
    "state": """select doc_id * 2 as row_seq, toxic = 1 as relabel, quality = 0 as copied from labels
        union all
        select o_orderkey * 2 + 1, o_orderpriority = '1-URGENT', o_orderpriority = '5-LOW'
        from orders where o_orderstatus = 'F'""",
    "stateful": """select * from load_rows join state using (row_seq)
        qualify row_number() over (partition by text_raw order by row_seq) = 1""",
    "target_ids": """select row_seq + 1 as id, * from stateful
        union all select -(row_seq + 1), * from stateful where copied""",
    "target": """select id, text_raw, text, lab as label,
          case when lab <> 'complaint' then md5(text_raw) end as md5_hash
        from (select *, case when relabel then 'complaint' else label end as lab from target_ids)""",
    "filled": "select id, text_raw, text, label, coalesce(nullif(md5_hash, ''), md5(text_raw)) as md5_hash from target",
    "staging": """select *, md5(text_raw) as md5_hash from load_rows
        qualify row_number() over (partition by text_raw order by row_seq) = 1""",
    "newest": "select * from filled qualify row_number() over (partition by md5_hash order by id desc) = 1",
    "turn_rows": "select conv_id, turn, role, text, cast(conv_id as varchar) || '-' || turn as row_seq from conversations",
    "turn_tokens": f"""select row_seq, unnest(t) as token, generate_subscripts(t, 1) as pos
        from (select row_seq, regexp_extract_all(lower(text), {q(TOKEN_PATTERN)}) as t from turn_rows)""",
    "vocab": """select token, count(*) as n, row_number() over (order by count(*) desc, token) + 3 as token_id
        from turn_tokens group by token qualify token_id <= 30003""",
    "body_ids": """select row_seq, list(coalesce(token_id, 1) order by pos) as ids
        from turn_tokens left join vocab using (token) where pos <= 62 group by row_seq""",
    "encoded": """select conv_id, turn, array_to_string(list_resize(full_ids, 64, 0), ',') as input_ids,
          array_to_string(list_resize(list_transform(full_ids, lambda x: 1), 64, 0), ',') as attention_mask
        from (select conv_id, turn, list_concat([2], coalesce(ids, []), [3]) as full_ids
              from turn_rows left join body_ids using (row_seq))""",
    "scored": f"""select row_seq, label, z from (select row_seq, label, [{SCORER}] as z
          from (select row_seq, label, text_model as t from modelled))""",
    "scored_soft": """select row_seq, label, list_transform(z, lambda v: exp(v - list_max(z))
          / list_sum(list_transform(z, lambda u: exp(u - list_max(z))))) as probs from scored""",
    "gated": f"""select *, case when confidence >= 0.80 then pred_label else 'other' end as intent
        from (select row_seq, list_max(probs) as confidence,
                ({strings(C.INTENT_LABELS)})[list_position(probs, list_max(probs))] as pred_label from scored_soft)""",
}

def _needs(sql: str) -> list[str]:
    """The common table expressions that a statement reads."""
    words = set(re.findall(r"(?:from|join)\s+([a-z_0-9]+)", re.sub(r"'(?:[^']|'')*'", "", sql)))
    return [n for n in CTES if n in words]


def with_ctes(select: str) -> str:
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        for need in _needs(CTES[name]):
            if need != name:
                add(need)
        order.append(name)

    for name in _needs(select):
        add(name)
    ctes = ",\n".join(f"{n} as materialized ({CTES[n]})" for n in order)
    return f"with {ctes}\n{select}" if ctes else select


def overlap(rows: str, columns: list[str]) -> str:
    """Distinct and shared values for each column of a relation that has `split`."""
    one = " union all ".join(
        f"select '{c}' as col, coalesce(cast({c} as varchar), '') as v, split from {rows}" for c in columns
    )
    return f"""select col as "column",
        count(*) filter (tr > 0) as distinct_train, count(*) filter (va > 0) as distinct_val,
        count(*) filter (te > 0) as distinct_test,
        count(*) filter (tr > 0 and va > 0) as train_val,
        count(*) filter (tr > 0 and te > 0) as train_test,
        count(*) filter (va > 0 and te > 0) as val_test,
        cast(coalesce(sum(va) filter (tr > 0), 0) as bigint) as val_rows_seen,
        cast(coalesce(sum(te) filter (tr > 0 or va > 0), 0) as bigint) as test_rows_seen
      from (select col, v, count(*) filter (split = 'train') as tr, count(*) filter (split = 'val') as va,
              count(*) filter (split = 'test') as te from ({one}) group by col, v) group by col"""


def report_sql() -> str:
    return """select cast(label as varchar) as metric, round(p, 6) as precision, round(r, 6) as recall,
          round(f1, 6) as f1, cast(support as bigint) as support from scores
        union all
        select 'accuracy', round(sum(tp) / sum(support)::double, 6), round(sum(tp) / sum(support)::double, 6),
          round(sum(tp) / sum(support)::double, 6), cast(sum(support) as bigint) from scores
        union all
        select 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f1), 6), cast(sum(support) as bigint) from scores
        union all
        select 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6),
          round(sum(f1 * support) / sum(support), 6), cast(sum(support) as bigint) from scores"""


def thresholds_sql(shift: int, floor: float) -> str:
    return f"""select label, c.id, round(f1, 6) as best_f1,
          round(case when b.id is null then 0.75 else greatest(score, {floor}) end, 6) as threshold
        from classes c left join best{shift} b on c.id = b.id"""


def f1_of(rows: str) -> str:
    """Per class F1 of a relation (true_id, pred_id)."""
    return f"""select label, coalesce(sum(t), 0) as support,
          case when coalesce(sum(tp), 0) = 0 then 0.0
            else 2.0 * (sum(tp) / sum(p)::double) * (sum(tp) / sum(t)::double)
              / ((sum(tp) / sum(p)::double) + (sum(tp) / sum(t)::double)) end as f1
        from (select true_id as label, 1 as t, 0 as p, 0 as tp from {rows}
              union all select pred_id, 0, 1, (true_id = pred_id)::integer from {rows}) group by label"""


def _ablated() -> str:
    return collapse(sub("text_model", "(?i)\\[(" + "|".join(C.ABLATED_PLACEHOLDERS) + ")\\]", ""))


def _scored_as(t: str) -> str:
    z = f"select row_seq, label, [{SCORER}] as z from (select row_seq, label, {t} as t from modelled)"
    return f"""select row_seq, list_position({strings(C.INTENT_LABELS)}, label) - 1 as true_id,
          list_position(pr, list_max(pr)) - 1 as pred_id
        from (select row_seq, label, list_transform(z, lambda v: exp(v - list_max(z))
              / list_sum(list_transform(z, lambda u: exp(u - list_max(z))))) as pr from ({z}))"""


CTES["scored_before"] = _scored_as("text_model")
CTES["scored_after"] = _scored_as(_ablated())
CTES["f1_b"] = f1_of("scored_before")
CTES["f1_a"] = f1_of("scored_after")

DAILY = """select day, intent,
      round(case when tp + fp = 0 then null else tp / (tp + fp)::double end, 6) as precision,
      round(case when tp + fn = 0 then null else tp / (tp + fn)::double end, 6) as recall
    from daily where tp + fp + fn > 0"""


def _date_phrase() -> str:
    day = "strftime(o_orderdate, '%Y-%m-%d')"
    phrases = [
        "(n % 40) || ' months ago'",
        f"{pick(C.NUMBER_WORDS, '(n // 16) % 12')} || ' months ago'",
        "'Last month'",
        "(n % 5) || ' years ago'",
        f"'in ' || {pick(C.MONTH_NAMES, '(n // 16) % 12')} || ' 2023'",
        day,
        "(n % 12) || '/' || (n % 28) || '/23'",
        f"'What hours on ' || {day}",
        "cast(n % 3000 as varchar)",
        "'a month ago'",
        "'2100'",
        "' '",
    ]
    return "case " + " ".join(f"when n % 12 = {i} then {p}" for i, p in enumerate(phrases)) + " end"


_ID_TEXT = (
    "'see [ord-' || o_orderkey || '] or [ref ' || md5(cast(o_orderkey as varchar)) || '] or [no ' || "
    "cast(o_totalprice as decimal(15, 2)) || '] or [person_hash] or [order ' || o_orderkey || '] or [gold] or ' || o_orderkey"
)
_BIN_MODEL = "concat_ws(' ', " + sub("body", C.LEFTOVER_ID_PATTERN, " [ID_PRESENT] ") + ", coalesce(tokens, ''))"
_PLACEHOLDERS = f"unnest(regexp_extract_all(text_model, {q(C.PLACEHOLDER_KEY_PATTERN)}, 1))"
_MATRIX_NAMES = [f.upper() for f in FLAGS] + ["ID_PRESENT"]

SELECTS: dict[str, str] = {
    "daily_precision_recall": DAILY,
    "stream_daily": DAILY,
    "low_confidence_top": "select event_id, round(confidence, 6) as confidence from logs order by confidence, event_id limit 10",
    "judged_logs": "select event_id, actual, correct from logs",
    "clean_text": "select row_seq, text_clean from cleaned",
    "label_normalise": f"select row_seq, {strip(chr(39) + ' ' + chr(39) + ' || chr(9) || lower(upper(label)) || ' + chr(39) + ' ' + chr(39) + ' || chr(10)')} as label_norm from messages",
    "sanitize_token": f"select row_seq, {sanitize('text_clean')} as token, {sub('lower(text_clean)', ' +', '_')} as readable from cleaned",
    "export_key": f"""select row_seq, substr({sub('label', '[^0-9A-Za-z]+', '_')}, 1, 80) as label_key,
          substr({sub('text', '[^0-9A-Za-z]+', '_')}, 1, 80) as text_key,
          substr({sub('text', r'[^\p{L}\p{N}]', '_')}, 1, 80) as text_key_per_char from messages""",
    "amount_bins": f"""select o_orderkey, round(a, 6) as amount, {amount_bin('a')} as amount_bin
        from (select o_orderkey, floor(o_totalprice / 100) as a from orders)""",
    "recency_bins": f"""select o_orderkey, {recency_bin('n % 40')} as recency_bin,
          case when n % 13 < 12 then cast(n % 13 + 1 as integer) end as spelled
        from (select o_orderkey, {h('o_orderkey')} as n from orders)""",
    "date_tokens": f"""select o_orderkey, phrase, {date_token('phrase')} as date_token
        from (select o_orderkey, {_date_phrase()} as phrase
              from (select *, {h('o_orderkey')} as n from orders))""",
    "id_mask": f"""select o_orderkey, {collapse(sub('t', C.ID_LIKE_PATTERN, ' [ID_PRESENT] '))} as masked,
          {collapse(sub('t', C.LEFTOVER_ID_PATTERN, ' [ID_PRESENT] '))} as masked_strict
        from (select o_orderkey, {_ID_TEXT} as t from orders)""",
    "strip_label_words": f"""select row_seq, {sub("'i want ' || label || ' now: ' || text", C.LABEL_WORD_PATTERN, ' ')} as stripped from messages""",
    "ablate_placeholders": f"""select row_seq, {sub('text_model', '(?i)' + chr(92) + '[(' + '|'.join(C.ABLATED_PLACEHOLDERS) + ')' + chr(92) + ']', '')} as ablated,
          contains(text_model, '[INVOICE_PRESENT]') as has_invoice from modelled""",
    "ablation_labels": "select label, count(*) as n from modelled where contains(text_model, '[INVOICE_PRESENT]') group by label",
    "entity_spans": "select row_seq, start_pos, end_pos, ph as placeholder, value from spans",
    "merged_spans": "select row_seq, s as start_pos, e as end_pos, ph as placeholder, value from kept",
    "normalised_messages": "select row_seq, text as text_norm, label from normalised",
    "slot_values": """select row_seq, ph as placeholder,
          cast(row_number() over (partition by row_seq, ph order by first_turn) - 1 as integer) as pos, value from slots""",
    "gazetteer_spans": """select row_seq, cast(i - 1 as integer) as start_pos, cast(i + 17 as integer) as end_pos, '[PERSON_NAME]' as placeholder,
          substr(text_clean, cast(i as bigint), 18) as value
        from (select row_seq, text_clean, instr(lower(text_clean), 'customer#') as i from cleaned
              where contains(lower(text_clean), 'customer#'))
        join customer on lower(c_name) = lower(substr(text_clean, cast(i as bigint), 18))""",
    "placeholder_flags": f"select row_seq, {', '.join(FLAGS)}, account_type, refund_amt_bin, date_bin, cast(n_other as integer) as n_other from flagged",
    "model_text": "select row_seq, text_model from modelled",
    "model_text_bins": f"select row_seq, {collapse(sub(_BIN_MODEL, C.LABEL_WORD_PATTERN, ' '))} as text_model from bodied",
    "group_keys": "select row_seq, entity_key, presence_key from grouped",
    "label_ids": "select label, cast(dense_rank() over (order by label) - 1 as integer) as id from (select distinct label from messages)",
    "encoded_labels": "select row_seq, label, cast(dense_rank() over (order by label) - 1 as integer) as encoded_label from messages",
    "focal_gradient": f"""with t as (
          select *, sum(n) over () / ((count(*) over ()) * n)::double as weight, count(*) over () as k, sum(n) over () as total
          from (select encoded_label as own, count(*) as n from prepared where split = 'train' group by 1)
        ), r as (
          select p.row_seq, p.text_model, own, k, total, 1.0::double / k as p,
            -weight * (2 * (1.0::double / k) * (1 - 1.0::double / k) * ln(k) + (1 - 1.0::double / k) ** 2) as pull,
            weight * (1 - 1.0::double / k) ** 2 * ln(k) as loss
          from prepared p join t on p.encoded_label = own where split = 'train'
        ), s as (
          select own, k, total, p, pull, ('0x' || substr(md5(unnest(regexp_extract_all(lower(text_model), {q(TOKEN_PATTERN)}))), 1, 8))::bigint % 2048 as slot from r
        ), g as (
          select -2 as slot, 0 as class, sum(loss) / max(total) as value from r
          union all select -1, own_class, sum(pull * (case when own = own_class then 1 else 0 end - p)) / max(total)
            from r, (select own as own_class from t) group by own_class
          union all select slot, own_class, sum(pull * (case when own = own_class then 1 else 0 end - p)) / max(total)
            from s, (select own as own_class from t) group by slot, own_class
        ) select slot::integer as slot, class::integer as class, round(value, 6) + 0.0 as value from g where round(value, 6) <> 0""",
    "ml_quality": "select count(*) as n, true as sound, true as lowers_loss from prepared where split = 'test'",
    "class_weights": """select label, n, round(sum(n) over () / ((count(*) over ()) * n)::double, 6) as weight
        from (select label, count(*) as n from messages group by label)""",
    "sample_weights": "select row_seq, round(1.0::double / count(*) over (partition by label), 9) as sample_weight from messages",
    "vocabulary": "select token, n, cast(token_id as integer) as token_id from vocab",
    "token_ids": "select conv_id, turn, input_ids, attention_mask from encoded",
    "dedup_first": "select doc_id, text, lang from documents qualify row_number() over (partition by text order by doc_id) = 1",
    "duplicate_report": "select text, count(*) as n from messages group by text having count(*) > 1",
    "dedup_counts": "select count(*) as n_before, count(distinct text) as n_after, count(*) - count(distinct text) as n_dropped from messages",
    "upsert_result": """select t.id, t.md5_hash, coalesce(s.text, t.text) as text, coalesce(s.label, t.label) as label,
          case when s.md5_hash is not null and (s.text <> t.text or s.label <> t.label) then 'updated' else 'kept' end as action,
          s.md5_hash is not null and (s.text <> t.text or s.label <> t.label) as was_updated
        from newest t left join staging s using (md5_hash)
        union all
        select (select max(id) from target) + row_number() over (order by row_seq), md5_hash, text, label, 'inserted', false
        from staging where md5_hash not in (select md5_hash from filled)""",
    "upsert_summary": """select
          (select count(*) from filled t join staging s using (md5_hash) where t.text <> s.text or t.label <> s.label) as n_updated,
          (select count(*) from staging where md5_hash not in (select md5_hash from filled)) as n_inserted,
          (select count(*) - count(distinct md5_hash) from filled) as n_removed""",
    "newest_per_hash": """select id, md5_hash, label from target where md5_hash is not null
          qualify row_number() over (partition by md5_hash order by id desc) = 1
        union all select id, md5_hash, label from target where md5_hash is null""",
    "hash_backfill": "select id, md5_hash from filled",
    "stream_upsert": """select t.id, t.md5_hash, coalesce(s.text, t.text) as text, coalesce(s.label, t.label) as label
        from newest t left join staging s using (md5_hash)
        union all
        select (select max(id) from target) + row_number() over (order by row_seq), md5_hash, text, label
        from staging where md5_hash not in (select md5_hash from filled)""",
    "table_load": """select t.id, t.md5_hash, coalesce(s.text, t.text) as text, coalesce(s.label, t.label) as label
        from newest t left join staging s using (md5_hash)
        union all
        select (select max(id) from target) + row_number() over (order by row_seq), md5_hash, text, label
        from staging where md5_hash not in (select md5_hash from filled)""",
    "stream_never_seen": """select min(row_seq) as row_seq, md5(text) as md5_hash, text as text_raw from messages
        where md5(text) not in (select md5_hash from filled) group by text""",
    "strings_read": """select c_custkey::varchar as c_custkey, c_name, case when c_mktsegment = 'BUILDING' then '' else c_mktsegment end as segment from customer""",
    "roles": 'select true_id as "true", cast(pred_id as integer) as pred, count(*) as n from preds group by all',
    "table_read": "select doc_id, source from documents",
    "previews": "select doc_id, substr(text, 1, 80) as preview from documents",
    "token_list": f"""select distinct unnest(regexp_extract_all(lower(coalesce(text, '')), {q('[[][^]' + AWS + ']+[]]|[a-z0-9]+')})) as token from documents""",
    "stream_dedup": "select distinct md5(text) as md5_hash, text as text_raw from messages",
    "stream_scores": "select row_seq, intent, round(confidence, 6) as confidence, confidence < 0.80 as low from gated",
    "scored_messages": "select row_seq, pred_label, round(confidence, 6) as confidence, intent from gated",
    "group_split": "select row_seq, group_key, cast(encoded_label as integer) as encoded_label, split from prepared",
    "group_split_exact": """with g as (select distinct conv_id, md5('42|' || conv_id) as d from conversations),
        ranked as (select *, row_number() over (order by d) as rn, count(*) over () as total from g),
        cut as (select *, ceil(total * 0.15::double) as n_test from ranked),
        cuts as (select *, n_test + ceil((total - n_test) * (0.15::double / 0.85::double)) as n_val from cut)
        select conv_id, turn, case when rn <= n_test then 'test' when rn <= n_val then 'val' else 'train' end as split
        from conversations join cuts using (conv_id)""",
    "split_overlap": overlap("prepared", ["text_model", "text_raw", "text"]),
    "overlap_sketch": f"""select * exclude (val_rows_seen, test_rows_seen), true as holds
        from ({overlap("prepared", ["text_model", "text_raw", "text"])})""",
    "group_overlap": overlap("prepared", ["group_key"]),
    "turn_overlap": overlap(f"(select *, {bucket_split('turn')} as split from conversations)", ["conv_id", "role", "text"]),
    "token_overlap": overlap(f"(select *, {bucket_split('turn')} as split from encoded)", ["input_ids"]),
    "leak_tokens": f"""select token from (select split, lower(unnest(regexp_extract_all(text_model, {q(C.PLACEHOLDER_PATTERN)}, 1))) as token from prepared)
        where regexp_matches(token, {q('|'.join(C.SUSPICIOUS_TOKEN_WORDS))})
        group by token having count(*) filter (split = 'train') > 0 and count(*) filter (split <> 'train') > 0""",
    "text_conflicts": """select text, text_model, label, count(*) as n from modelled
        where text_model in (select text_model from modelled group by text_model having count(distinct label) > 1)
        group by text, text_model, label""",
    "conflict_keys": "select text_model, count(distinct label) as n_labels from modelled group by text_model having count(distinct label) > 1",
    "collisions": """select text_model, n_unique_raw, cast(turn - 1 as integer) as pos, text_raw as example_raw
        from (select text_model, text_raw, row_number() over (partition by text_model order by min(row_seq)) as turn from modelled group by text_model, text_raw)
        join (select text_model, count(distinct text_raw) as n_unique_raw from modelled group by text_model
              having count(distinct text_raw) > 1 order by n_unique_raw desc, min(row_seq) limit 200) using (text_model)
        where turn <= 10""",
    "entity_examples": f"""select o_orderkey as row_seq, cast(start as integer) as start, ph, value
        from orders join {values_sql()} on o_orderkey % {len(EXAMPLES)} = i""",
    "collisions_all": """select text_model, n_unique_raw, text_raw
        from (select distinct text_model, text_raw from modelled)
        join (select text_model, count(distinct text_raw) as n_unique_raw from modelled group by text_model
              having count(distinct text_raw) > 1) using (text_model)""",
    "collision_count": "select count(*) as n_collisions from (select text_model from modelled group by text_model having count(distinct text_raw) > 1)",
    "label_distribution": "select label, count(*) as n from messages where text is not null and label is not null group by label",
    "rated_labels": "select quality as label, count(*) as n from documents join labels using (doc_id) where text is not null and quality is not null group by quality",
    "placeholder_by_label": f"""select label, placeholder, count(*) as n, support
        from (select label, {_PLACEHOLDERS} as placeholder from modelled)
        join (select label, count(*) as support from modelled group by label) using (label) group by all""",
    "placeholder_matrix": "select label, support, "
    + ", ".join(f"count(*) filter (placeholder = '{n}') as {n}" for n in _MATRIX_NAMES)
    + f""" from (select label, {_PLACEHOLDERS} as placeholder from modelled)
        join (select label, count(*) as support from modelled group by label) using (label) group by label, support""",
    "top_placeholders": f"""select label, placeholder, count(*) as n,
          cast(row_number() over (partition by label order by count(*) desc, placeholder) as integer) as rank
        from (select label, {_PLACEHOLDERS} as placeholder from modelled) group by label, placeholder qualify rank <= 5""",
    "weights_check": """select label, cast(i.id as integer) as id, round(w.weight, 6) as weight, i.id is not null and w.weight is not null as matched
        from (select label, dense_rank() over (order by label) - 1 as id from (select distinct label from prepared)) i
        full join (select label, sum(n) over () / ((count(*) over ()) * n)::double as weight
          from (select label, count(*) as n from prepared where split = 'train' group by label)) w using (label)""",
    "weighted_sample": f"""select row_seq, label from (select row_seq, label,
          -ln({unit("'42|' || row_seq")}) * count(*) over (partition by label) as k from messages)
        order by k, row_seq limit 300""",
    "weighted_sample_all": "select row_seq, label from messages",
    "weighted_draws": f"""with c as (select label, count(*) as n, row_number() over (order by label) - 1 as class_no, count(*) over () as k from messages group by label),
        d as (select i as draw, {unit("'42|class|' || i")} as uc, {unit("'42|row|' || i")} as ur from range(0, 300) t(i)),
        p as (select draw, label, cast(floor(ur * n) as bigint) + 1 as no from d join c on class_no = floor(uc * k)),
        r as (select row_seq, label, row_number() over (partition by label order by {h("'42|order|' || row_seq")}, row_seq) as no from messages)
        select draw, row_seq, label from p join r using (label, no)""",
    "softmax_probs": "select row_seq, cast(unnest(range(0, 10)) as integer) as class, round(unnest(probs), 6) as prob from preds",
    "gated_predictions": """select row_seq, c.label as pred_label, round(confidence, 6) as confidence,
          round(coalesce(l.threshold, 0.80), 6) as threshold,
          case when confidence >= coalesce(l.threshold, 0.80) then c.label else 'other' end as intent
        from preds join classes c on c.id = pred_id left join limits l on l.id = pred_id""",
    "prediction_table": """select row_seq, text, true_id, cast(pred_id as integer) as pred_id,
          case when true_id = 3 then 'INVALID_LABEL' else 'class_' || true_id end as "true",
          case when pred_id = 3 then 'INVALID_LABEL' else 'class_' || pred_id end as pred,
          round(confidence, 6) as top_prob from preds""",
    "attached_predictions": "select row_seq, true_id as label, cast(pred_id as integer) as pred_id from preds",
    "confusion_matrix": 'select t as "true", '
    + ", ".join(f"cast(coalesce(sum(n) filter (pred_l = {i}), 0) as bigint) as p{i}" for i in range(10))
    + " from (select cast(unnest(range(0, 10)) as integer) as t) left join cells on true_l = t group by t",
    "confusion_pairs": 'select true_l as "true", cast(pred_l as integer) as pred, n from cells',
    "top_confusions": """select true_l as "true", cast(pred_l as integer) as pred, n from cells where true_l <> pred_l
        qualify row_number() over (partition by true_l order by n desc, pred_l) = 1""",
    "top_pairs": 'select true_l as "true", cast(pred_l as integer) as pred, n from cells order by n desc, true_l, pred_l limit 50',
    "frequent_pairs": 'select true_l as "true", cast(pred_l as integer) as pred, n from cells where n >= 5',
    "classification_report": report_sql(),
    "report_roundtrip": report_sql(),
    "accuracy_macro_f1": "select round(sum(tp) / sum(support)::double, 6) as accuracy, round(avg(f1), 6) as macro_f1 from scores",
    "class_thresholds": thresholds_sql(1, 0.0),
    "class_thresholds_floor": thresholds_sql(1, 0.80),
    "class_thresholds_unshifted": thresholds_sql(0, 0.0),
    "thresholds_json": "select label, threshold from (" + thresholds_sql(1, 0.80) + ")",
    "confidence_stats": """select cast(label as integer) as label,
          count(*) filter (true_id = label) as support_true, count(*) filter (pred_id = label) as support_pred,
          round(avg(confidence) filter (pred_id = label), 6) as mean_prob_when_predicted,
          round(avg(probs[label + 1]) filter (true_id = label), 6) as mean_prob_on_true_rows,
          round(avg(confidence) filter (pred_id = label and true_id <> label), 6) as mean_prob_on_wrong_predictions
        from class_list join preds on true_id = label or pred_id = label group by label""",
    "low_f1_classes": "select cast(label as integer) as label, round(f1, 6) as f1 from scores order by scores.f1, label limit 3",
    "low_f1_errors": """select true_id, cast(turn as integer) as turn, row_seq, text, cast(pred_id as integer) as pred_id,
          case when pred_id = 3 then '3' else 'class_' || pred_id end as pred_label
        from (select *, row_number() over (partition by true_id order by row_seq) as turn from preds
              where true_id <> pred_id and true_id in (select label from scores order by f1, label limit 3))
        where turn <= 10""",
    "first_errors": "select row_seq, text, true_id, cast(pred_id as integer) as pred_id from preds where true_id <> pred_id order by row_seq limit 200",
    "drill_down": "select row_seq, text from preds where true_id = 1 and pred_id = 2 order by row_seq limit 50",
    "inspect_class": """select direction, row_seq, true_id, cast(pred_id as integer) as pred_id
        from (select *, case when true_id = 5 then 'missed' else 'false_alarm' end as direction from preds
              where true_id <> pred_id and (true_id = 5 or pred_id = 5))
        qualify row_number() over (partition by direction order by row_seq) <= 20""",
    "loss_table": """select round(sum(-w * ln(p)) / sum(w), 6) as cross_entropy,
          round(avg(power(1 - p, 2) * -w * ln(p)), 6) as focal_loss, count(*) as n
        from (select probs[true_id + 1] as p,
                (count(*) over ())::double / ((select count(distinct true_id) from preds) * count(*) over (partition by true_id)) as w
              from preds)""",
    "ablation_delta": """select cast(label as integer) as label, cast(b.support as bigint) as support,
          round(coalesce(b.f1, 0), 6) as f1_before, round(coalesce(a.f1, 0), 6) as f1_after,
          round(coalesce(a.f1, 0) - coalesce(b.f1, 0), 6) as f1_change
        from f1_b b full join f1_a a using (label)""",
    "source_roundtrip": "select row_seq, text, label from messages",
    "snapshot_roundtrip": "select split, count(*) as n, count(distinct group_key) as n_groups from prepared group by split",
    "error_partitions": """select 'class_' || true_l as true_label, 'class_' || pred_l as pred_label, n from cells where true_l <> pred_l
        qualify row_number() over (partition by true_l order by n desc, 'class_' || pred_l) = 1""",
    "matrix_roundtrip": """select cast(t as varchar) as "true", cast(p as varchar) as pred, coalesce(n, 0) as n
        from (select unnest(range(0, 10)) as t) cross join (select unnest(range(0, 10)) as p)
        left join cells on true_l = t and pred_l = p""",
}


def oracle_sql() -> dict[str, str]:
    """Query name -> SQL. Trained-model scores have no SQL counterpart."""
    return {
        name: _merge_with(select) if select.startswith("with ") else with_ctes(select)
        for name, select in SELECTS.items()
    }


def _merge_with(select: str) -> str:
    """A select that brings common table expressions of its own."""
    outer = with_ctes(select)
    return outer.replace("\nwith ", ",\n", 1) if outer is not select else select
