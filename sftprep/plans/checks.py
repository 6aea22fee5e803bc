"""The same queries as plain SQL over the same tables, for a second engine to run."""

from __future__ import annotations

from sftprep.operators.prompts import BLOCK_INTRO, CHAT_INTRO, INLINE_INTRO

# The second engine names scripts without the prefix.
PIECE = r"[ \t\r\n\x{3000}]?[\p{Latin}\p{Greek}\p{Cyrillic}\p{M}\p{N}]+|(?s:.)"


def _text(value: str) -> str:
    """A string literal; line breaks are allowed inside quotes."""
    return "'" + value.replace("'", "''") + "'"


def _query(*parts: str) -> str:
    """Named tables followed by the final select."""
    *tables, final = parts
    return "with recursive " + ",\n".join(tables) + "\n" + final if tables else final


def _digest(ids: str) -> str:
    return f"md5(array_to_string({ids}::varchar[], ' '))"


# Instruction tables

INSTRUCT = """instruct as (
  select x.conv_id || ':' || x.turn as rec_id, x.text as instruction,
         coalesce(sy.text, '') as input, x.nt as output
  from (select *, lead(role) over (partition by conv_id order by turn) as nr,
                  lead(text) over (partition by conv_id order by turn) as nt
        from conversations) x
  left join (select conv_id, text from conversations where role = 'system') sy
    on x.conv_id = sy.conv_id
  where x.role = 'user' and x.nr = 'assistant')"""

DOC_INSTRUCT = """doc_instruct as (
  select doc_id as rec_id,
         case when strpos(text, chr(10)) = 0 then text
              else substr(text, 1, strpos(text, chr(10)) - 1) end as instruction,
         case when doc_id % 3 = 0 then source else '' end as input,
         case when strpos(text, chr(10)) = 0 then ''
              else substr(text, strpos(text, chr(10)) + 1) end as output
  from documents)"""


def _block(name: str, rows: str, context: str = "input") -> str:
    return f"""{name} as (
  select *, {_text(BLOCK_INTRO)} || chr(10) || chr(10) || 'USER:' || chr(10)
    || coalesce(instruction, 'None')
    || case when coalesce({context}, '') <> ''
            then chr(10) || chr(10) || 'INPUT:' || chr(10) || {context} else '' end
    || chr(10) || chr(10) || 'ASSISTANT:' || chr(10) || coalesce(output, 'None') as text
  from {rows})"""


def _inline(name: str, rows: str) -> str:
    return f"""{name} as (
  select *, {_text(INLINE_INTRO)} || ' USER:' || coalesce(instruction, 'None')
    || case when coalesce(input, '') <> '' then ' INPUT:' || input else '' end
    || ' ASSISTANT:' || coalesce(output, 'None') as text
  from {rows})"""


# Tokens

DOC_PIECES = f"dp as (select doc_id as id, regexp_extract_all(text, '{PIECE}') as p from documents)"



def _vocab(source: str) -> str:
    """Pieces of ``source (id, p)`` from id 259 on, then characters of other pieces."""
    return f"""counted as (select piece, count(*) as n from (select unnest(p) as piece from {source})
        group by piece),
top as (select piece, row_number() over (order by n desc, piece) as place from counted
        order by n desc, piece limit 8192),
letters as (select distinct unnest(regexp_extract_all(piece, '(?s:.)')) as piece from counted),
rest as (select piece, row_number() over (order by piece) as place
         from letters anti join top using (piece)),
vocab as (select piece, (place + 258)::integer as token_id from top
  union all select piece, (place + 258 + (select count(*) from top))::integer from rest),
spelling as (select 0 as token_id, '<unk>' as piece, hex(encode('<unk>')) as hex
  union all select 1, '<s>', hex(encode('<s>')) union all select 2, '</s>', hex(encode('</s>'))
  union all select (b + 3)::integer, '<0x' || printf('%02X', b) || '>', printf('%02X', b)
    from (select unnest(range(256)) as b)
  union all select token_id, piece, hex(encode(piece)) from vocab)"""


VOCAB = _vocab("dp")


def _encoded(name: str, source: str, cap: int | None = None, eos: bool = True) -> str:
    """``id, ids`` from ``id, p``; cap counts both special tokens."""
    p = f"p[1:{cap - 2}]" if cap else "p"
    cut = f"[1:{cap - 2}]" if cap else ""
    end = "[2]" if eos else "[]::integer[]"
    return f"""rare_{name} as (
  select piece, unnest(regexp_extract_all(piece, '(?s:.)')) as c,
    generate_subscripts(regexp_extract_all(piece, '(?s:.)'), 1) as pos
  from (select distinct piece from (select unnest({p}) as piece from {source})
        anti join vocab using (piece))),
spelt_{name} as (
  select r.piece, flatten(list(case when v.token_id is null
      then list_transform(range(1, len(hex(encode(c))), 2),
        lambda i: (('0x' || substr(hex(encode(c)), i, 2))::integer + 3)::integer)
      else [v.token_id] end order by pos)) as ids
  from rare_{name} r left join vocab v on v.piece = r.c group by r.piece
  union all select piece, [token_id] from vocab),
{name} as (
  select s.id, list_concat(list_concat([1::integer], coalesce(b.l, []::integer[]){cut}), {end}) as ids
  from {source} s left join (
    select t.id, flatten(list(v.ids order by t.pos)) as l
    from (select id, unnest({p}) as piece, generate_subscripts({p}, 1) as pos from {source}) t
    join spelt_{name} v on t.piece = v.piece group by t.id) b on s.id = b.id)"""


DOC_TOKENS = (DOC_PIECES, VOCAB, _encoded("enc", "dp"))
CUT_TOKENS = (DOC_PIECES, VOCAB, _encoded("enc", "dp", 512))
IDS = f"""select id as doc_id, len(ids)::integer as length,
  len(list_filter(ids, lambda x: x = 0))::integer as n_unk, {_digest("ids")} as ids_md5 from enc"""


def _ranked(name: str, source: str, key: str, group: str = "", keep: str = "*") -> str:
    over = f"partition by {group} " if group else ""
    return f"""{name} as (
  select {keep}, row_number() over ({over}order by md5({key}), id) as rank from {source})"""


def _split(name: str, source: str, share: float, seed: int) -> str:
    return f"""{name} as (
  select * exclude (r, n), case when r <= ceil({share}::double * n) then 'test' else 'train' end
    as split
  from (select *, row_number() over (order by md5('{seed}:' || id), id) as r,
               count(*) over () as n from {source}))"""


# Model


def _pairs(name: str, source: str, extra: str = "") -> str:
    return f"""{name} as (
  select {extra} prev, next from (
    select {extra} unnest(ids[1:len(ids) - 1]) as prev, unnest(ids[2:]) as next from {source})
  where next <> 0)"""


def _counts(name: str, pairs: str) -> str:
    return f"{name} as (select prev, next, count(*) as n from {pairs} group by prev, next)"


def _model_digest(source: str, by: str) -> str:
    return f"""select {by}, count(*) as n_pairs, sum(n)::bigint as n,
  sum((next::bigint * 31 + prev) % 9973 * n)::bigint as pairs_check from {source} group by {by}"""


def _probs_digest(source: str) -> str:
    return f"""select prev, count(*) as n_pairs,
  sum(round(p * 1e6::double)::bigint * (next % 997 + 1))::bigint as p_check
  from {source} group by prev"""


SPLIT_TOKENS = (
    *DOC_TOKENS,
    _split("sp", "enc", 0.1, 45),
    "train as (select id, ids from sp where split = 'train')",
    "test as (select id, ids from sp where split = 'test')",
)
PLACED = (
    *SPLIT_TOKENS,
    "size as (select count(*) as n from train)",
    "repeated as (select *, unnest([0, 1]) as epoch from train)",
    _ranked("ordered", "repeated", "'45:' || epoch || ':' || id", "epoch"),
    """placed as (select *, epoch * ceil((select n from size) / 16)::bigint + (rank - 1) // 16 as step
      from ordered)""",
    "cadence as (select 25 as every)",
    """points as (select unnest(range(1, (select max(step) // any_value(every) + 2
      from placed, cadence))) as checkpoint)""",
)
STATES = (
    *PLACED,
    _pairs("tp", "placed", "step, "),
    """states as (
  select checkpoint::integer as checkpoint, prev, next, count(*) as n
  from tp, cadence, points where tp.step // every < checkpoint group by all)""",
)
LOSS = """p_of as (
  select h.checkpoint, h.weight,
    0.7::double * coalesce(s.n / c.n, 0::double)
      + (1.0::double - 0.7::double) * ((coalesce(u.n, 0) + 1) / (t.n + t.types + 1)) as p
  from (select checkpoint, prev, next, weight from held cross join (select distinct checkpoint
        from states)) h
  left join states s using (checkpoint, prev, next)
  left join (select checkpoint, prev, sum(n)::bigint as n from states group by all) c
    on c.checkpoint = h.checkpoint and c.prev = h.prev
  left join (select checkpoint, next, sum(n)::bigint as n from states group by all) u
    on u.checkpoint = h.checkpoint and u.next = h.next
  join (select checkpoint, sum(n)::bigint as n, count(distinct next) as types from states
        group by checkpoint) t on t.checkpoint = h.checkpoint),
losses as (select checkpoint, sum(-ln(p) * weight) / sum(weight) as eval_loss,
  sum(weight)::bigint as eval_tokens from p_of group by checkpoint)"""
HELD = (
    _pairs("ep", "test"),
    "held as (select prev, next, count(*) as weight from ep group by prev, next)",
)
DOC_MODEL = (*DOC_TOKENS, _pairs("bg", "enc"), _counts("lm", "bg"))
PROBS = "probs as (select prev, next, n / sum(n) over (partition by prev) as p from lm)"
TEMPERED = """tempered as (select prev, next, power(p, 1.0::double / 0.7::double)
  / sum(power(p, 1.0::double / 0.7::double)) over (partition by prev) as p from probs)"""


# The log: pairs of an interval of ten steps against what all earlier ones have counted.
LOGGED = (
    *PLACED,
    _pairs("tp", "placed", "step, "),
    "grown as (select step // 10 as interval, prev, next, count(*) as n from tp group by all)",
    """sums as (
  select g.interval, g.n,
    (select coalesce(sum(n), 0) from grown b where b.interval < g.interval and b.prev = g.prev and b.next = g.next) as pairs,
    (select coalesce(sum(n), 0) from grown b where b.interval < g.interval and b.prev = g.prev) as context,
    (select coalesce(sum(n), 0) from grown b where b.interval < g.interval and b.next = g.next) as alone,
    (select coalesce(sum(n), 0) from grown b where b.interval < g.interval) as tokens,
    (select count(distinct next) from grown b where b.interval < g.interval) as types
  from grown g)""",
    """scored as (select interval, n, 0.7::double * case when context = 0 then 0 else pairs::double / context end
    + (1.0::double - 0.7::double) * (alone + 1)::double / (tokens + types + 1) as p from sums)""",
)



def _grams(name: str, source: str) -> str:
    return f"""{name} as (
  select ids[greatest(i - 2, 1):i - 1] as context, ids[i] as next
  from (select ids, unnest(range(2, len(ids) + 1)) as i from {source}) where ids[i] <> 0)"""


GRAMS = (
    *SPLIT_TOKENS,
    _grams("seen", "train"),
    """grams as materialized (
  select k as length, context[len(context) - k + 1:] as context, next, count(*) as n
  from (select context, next, unnest(range(0, len(context) + 1)) as k from seen) group by all)""",
)
GRAM_LOSS = (
    *GRAMS,
    _grams("later", "test"),
    "asked as (select context, next, count(*) as weight from later group by all)",
    "totals as (select length, context, sum(n)::double as total, count(*) as types from grams group by 1, 2)",
    """zero as (select a.*, (coalesce(g.n, 0) + 1)::double / (t.total + t.types + 1) as p0
  from asked a left join grams g on g.length = 0 and g.next = a.next join totals t on t.length = 0)""",
    """one as (select z.*, case when t.total is null then p0
    else 0.7::double * coalesce(g.n, 0) / t.total + (1.0::double - 0.7::double) * p0 end as p1
  from zero z left join totals t on t.length = 1 and t.context = z.context[-1:]
  left join grams g on g.length = 1 and g.context = z.context[-1:] and g.next = z.next)""",
    """two as (select o.weight, case when t.total is null then p1
    else 0.7::double * coalesce(g.n, 0) / t.total + (1.0::double - 0.7::double) * p1 end as p
  from one o left join totals t on t.length = 2 and t.context = o.context
  left join grams g on g.length = 2 and g.context = o.context and g.next = o.next)""",
)

# Merges of a public vocabulary: each step joins, in every piece, the leftmost of the
# neighbours that make the token of lowest id.
SUBWORDS = """ranks as materialized (
  select hex(from_base64(token)) as token, id from read_csv('/opt/tokenizers/byte_bpe_50k.tiktoken',
    delim = ' ', header = false, quote = '', escape = '', columns = {'token': 'varchar', 'id': 'integer'})),
words as materialized (select distinct piece from (select unnest(p) as piece from dp)),
steps as (
  select piece, regexp_extract_all(hex(encode(piece)), '..') as parts, 0 as step from words
  union all
  select piece, list_concat(parts[1:best - 1], list_concat([parts[best] || parts[best + 1]], parts[best + 2:])) as parts, step + 1
  from (
    select piece, any_value(parts) as parts, step, arg_min(i, id * 100000::bigint + i) as best
    from (select piece, parts, step, unnest(range(1, len(parts))) as i from steps) s
    join ranks on token = parts[i] || parts[i + 1]
    group by piece, step)),
ends as (select piece, arg_max(parts, step) as parts from steps group by piece),
spelt as materialized (
  select piece, list(id order by i) as ids
  from (select piece, unnest(parts) as token, generate_subscripts(parts, 1) as i from ends) join ranks using (token)
  group by piece),
subwords as (
  select id, flatten(list(ids order by i)) as ids
  from (select id, unnest(p) as piece, generate_subscripts(p, 1) as i from dp) join spelt using (piece) group by id)"""

# Drawing. Each kept choice owns an interval [lo, hi) of the uniform number.


def _choices(
    temperatures: str, model: str = "lm", weight: str = "n", top_p: float = 0.7
) -> str:
    return f"""heads as (
  select * from (
    select prev, next, w / max(w) over (partition by prev) as w,
           row_number() over (partition by prev order by w desc, next) as rank
    from (select prev, next, {weight}::double as w from {model}
          union all select -1, next, sum(n)::double from lm group by next)) where rank <= 50),
warm as (select t, prev, next, rank, power(w, 1.0::double / t) as w
  from heads cross join (select unnest({temperatures})::double as t)),
summed as (select *, sum(w) over (partition by t, prev order by rank
    rows between unbounded preceding and current row) as s,
  sum(w) over (partition by t, prev) as z from warm),
kept as (select *, coalesce(lag(s) over (partition by t, prev order by rank), 0) as s0
  from summed qualify round(s0 / z, 9) < {top_p}::double),
choices as materialized (select t, prev, next, rank,
  case when rank = 1 then -1 else round(s0 / max(s) over (partition by t, prev), 9) end as lo,
  case when rank = max(rank) over (partition by t, prev) then 2
       else round(s / max(s) over (partition by t, prev), 9) end as hi
  from kept),
known as materialized (select distinct prev from {model})"""


def _u(*parts: str) -> str:
    key = " || ':' || ".join(("'45'", *parts))
    return f"(('0x' || substr(md5({key}), 1, 8))::bigint / 4294967296::double)"


def _continued(asked: str) -> str:
    """Follows each prompt of ``asked (id, ids, t, max_tokens)`` to its end."""
    return f"""walk as (
  select id, t, max_tokens, 0 as step, ids[len(ids)] as prev, []::integer[] as drawn
  from {asked} where max_tokens > 0
  union all
  select g.id, g.t, g.max_tokens, g.step + 1, c.next, list_append(g.drawn, c.next)
  from walk g left join known k on k.prev = g.prev
  join choices c on c.t = g.t and c.prev = coalesce(k.prev, -1)
    and {_u("g.id", "g.step")} >= c.lo and {_u("g.id", "g.step")} < c.hi
  where (g.step = 0 or g.prev <> 2) and g.step < g.max_tokens),
answers as (
  select a.id, a.ids, coalesce(w.drawn, []::integer[]) as drawn from {asked} a
  left join (select id, arg_max(drawn, step) as drawn from walk group by id) w on w.id = a.id)"""


PLAIN = f"{_text(BLOCK_INTRO)} || ' ' || chr(10) || 'USER:' || chr(12288) || text || ' ' || chr(10) || 'ASSISTANT:'"
MARKED = PLAIN.replace("'USER:'", "'### USER:'").replace("'ASSISTANT:'", "'### ASSISTANT:'")
CHAT = f"{_text(CHAT_INTRO)} || ' USER: ' || text || ' ASSISTANT:'"
SECTIONS = (
    f"{_text(BLOCK_INTRO)} || chr(10) || '### Instruction:' || chr(10) || text"
    " || chr(10) || chr(10) || '### Response: '"
)
ASKED = (
    f"pp as (select item_id as id, regexp_extract_all({PLAIN}, '{PIECE}') as p from benchmark)",
    _encoded("pe", "pp", eos=False),
    "asked as (select id, ids, 0.7::double as t, 100 as max_tokens from pe)",
)
GENERATED = (*DOC_MODEL, *ASKED, _choices("[0.7]"), _continued("asked"))
DRAWN = f"""select id as prompt_id, len(drawn)::integer as n_drawn,
  {_digest("list_concat(ids, drawn)")} as ids_md5 from answers"""
MIXED = (
    *DOC_MODEL,
    INSTRUCT,
    _block("block", "instruct"),
    f"ip as (select rec_id as id, regexp_extract_all(text, '{PIECE}') as p from block)",
    _encoded("ie", "ip"),
    _pairs("ib", "ie"),
    _counts("dm", "ib"),
    """mixed as (select prev, next, coalesce(b.n, 0) as nb, coalesce(d.n, 0) as nd
      from lm b full join dm d using (prev, next))""",
    """shared as (select *, sum(nb) over (partition by prev) as tb,
      sum(nd) over (partition by prev) as td from mixed)""",
    """weighed as (select *, case when tb = 0 then 1::double when td = 0 then 0::double
      else 0.7::double end as share from shared)""",
    """mix as (select prev, next, share * nd / greatest(td, 1)
      + (1 - share) * nb / greatest(tb, 1) as p from weighed)""",
)

# Whole runs


def _tokenized(share: float, seed: int, layout, epochs: str) -> tuple[str, ...]:
    return (
        DOC_INSTRUCT,
        layout("rendered", "doc_instruct"),
        f"rp as (select rec_id as id, regexp_extract_all(text, '{PIECE}') as p from rendered)",
        _vocab("rp"),
        _encoded("enc", "rp", 512),
        _split("sp", "enc", share, seed),
        "train as (select id, ids, len(ids) as length from sp where split = 'train')",
        "size as (select count(*) as n from train)",
        f"repeated as (select *, unnest(range((select {epochs} from size)))::integer as epoch from train)",
        _ranked("ordered", "repeated", f"'{seed}:' || epoch || ':' || id", "epoch"),
    )


BY_LENGTH = (
    "factor as (select greatest(1, least(n // 16, 50)) as mega from size)",
    "grouped as (select *, (rank - 1) // (4 * mega) as m from ordered, factor)",
    """sorted as (select *, row_number() over (partition by epoch, m
      order by length desc, id) - 1 as place from grouped)""",
    "batched as (select *, m * mega + place // 4 as batch_id, place % 4 as slot from sorted)",
)


def _placed_run(batch: int, accum: int, world: int, cap: int = 1 << 62) -> tuple[str, ...]:
    return (
        f"""stepped as (select *, epoch * ceil((select n from size) / {batch * accum * world})::bigint
          + batch_id // {accum * world} as step,
          max(length) over (partition by epoch, batch_id) as width from batched)""",
        f"""padded as (select *, list_concat(ids,
          list_transform(range(width - length), lambda x: 0::integer)) as padded_ids
          from stepped where step < {cap})""",
        f"""select (batch_id % {world})::integer as worker, epoch, step, batch_id,
          slot::integer as slot, id as rec_id, length::integer as length,
          width::integer as width, {_digest("padded_ids")} as ids_md5,
          {_digest("list_transform(padded_ids, lambda x: case when x = 0 then -100 else x end)")}
            as labels_md5 from padded""",
    )


CAPPED_LENGTHS = (*CUT_TOKENS, "lens as (select id, len(ids) as length from enc)")

SAMPLED = _query(
        *DOC_MODEL,
        _choices("[0.7]"),
        "ctx as (select id, ids[len(ids) - 1] as prev, unnest(range(8))::integer as step from enc)",
        f"""select x.id as doc_id, x.step, x.prev, c.next from ctx x
        left join known k on k.prev = x.prev
        join choices c on c.prev = coalesce(k.prev, -1)
          and {_u("x.id", "x.step")} >= c.lo and {_u("x.id", "x.step")} < c.hi""",
    )

_FULL_RUN = _query(
    *_tokenized(0.2, 68, _inline, "2"),
    "batched as (select *, rank - 1 as batch_id, 0 as slot from ordered)",
    *_placed_run(1, 1, 4),
)

CHECKS: dict[str, str] = {
    "load_split": "select doc_id, lang, source, n_chars, md5(text) as text_md5 from documents",
    "count_records": _query(
        INSTRUCT,
        """select 'documents' as dataset, count(*) as n_rows from documents
        union all select 'instruct', count(*) from instruct
        union all select 'requests', count(*) from benchmark""",
    ),
    "peek": _query(
        INSTRUCT,
        _block("block", "instruct"),
        _split("sp", "(select rec_id as id, text from block)", 0.1, 45),
        """select id as rec_id, text from sp where split = 'train'
        order by md5('45:' || id), id limit 1""",
    ),
    "save_dataset": _query(
        DOC_INSTRUCT,
        _block("block", "doc_instruct"),
        _split("sp", "(select rec_id as id, text from block)", 0.1, 45),
        "select id as rec_id, split, md5(text) as text_md5 from sp",
    ),
    "save_lm": _query(*STATES, _model_digest("states", "checkpoint")),
    "load_lm": _query(
        *STATES,
        _model_digest(
            "(select * from states where checkpoint = (select max(checkpoint) from states))", "prev"
        ),
    ),
    "format_block": _query(
        INSTRUCT, _block("block", "instruct"), "select rec_id, text from block"
    ),
    "format_block_documents": _query(
        DOC_INSTRUCT,
        _block("block", "doc_instruct"),
        "select rec_id, length(text)::integer as n_chars, md5(text) as text_md5 from block",
    ),
    "format_inline": _query(
        INSTRUCT, _inline("inline", "instruct"), "select rec_id, text from inline"
    ),
    "format_inline_documents": _query(
        DOC_INSTRUCT,
        _inline("inline", "doc_instruct"),
        "select rec_id, length(text)::integer as n_chars, md5(text) as text_md5 from inline",
    ),
    "field_binding": _query(
        INSTRUCT,
        _block("block", "instruct"),
        _block("bare", "instruct", "null::varchar"),
        """select 'input_output' as family, rec_id, md5(text) as text_md5 from block
        union all select 'context_response', rec_id, md5(text) from block
        union all select 'no_context', rec_id, md5(text) from bare""",
    ),
    "truthy_context": _query(
        DOC_INSTRUCT,
        "select rec_id, (coalesce(input, '') <> '')::integer as has_context from doc_instruct",
    ),
    "inference_prompt": f"""select 'marked' as style, item_id as prompt_id, {MARKED} as prompt
        from benchmark
        union all select 'plain', item_id, {PLAIN} from benchmark
        union all select 'chat', item_id, {CHAT} from benchmark
        union all select 'sections', item_id, {SECTIONS} from benchmark""",
    "pieces": _query(
        DOC_PIECES,
        """select id as doc_id, len(p)::integer as n_pieces,
        md5(array_to_string(p, '|')) as pieces_md5 from dp""",
    ),
    "build_vocab": _query(DOC_PIECES, VOCAB, "select token_id::integer as token_id, piece from spelling"),
    "encode": _query(*DOC_TOKENS, IDS),
    "encode_by_join": _query(*DOC_TOKENS, IDS),
    "stream_encode": _query(*DOC_TOKENS, IDS),
    "truncate": _query(*CUT_TOKENS, IDS),
    "pad_batch": _query(
        *CUT_TOKENS,
        _ranked("ranked", "enc", "'45:' || id"),
        """batched as (select id, ids, len(ids) as length, (rank - 1) // 4 as batch_id,
          max(len(ids)) over (partition by (rank - 1) // 4) as width from ranked)""",
        f"""select id as doc_id, batch_id, length::integer as length, width::integer as width,
          length::integer as mask_sum,
          {_digest("list_concat(ids, list_transform(range(width - length), lambda x: 0::integer))")}
            as ids_md5
        from batched""",
    ),
    "with_length": _query(*DOC_TOKENS, "select id as doc_id, len(ids)::integer as length from enc"),
    "causal_labels": _query(
        *DOC_TOKENS,
        f"""select id as doc_id, len(list_filter(ids, lambda x: x = 0))::integer as n_ignored,
        {_digest("list_transform(ids, lambda x: case when x = 0 then -100 else x end)")}
          as labels_md5 from enc""",
    ),
    "only_full_length": _query(
        *CUT_TOKENS,
        f"""select id as doc_id, len(ids)::integer as length, {_digest("ids")} as ids_md5
        from enc where len(ids) = 512""",
    ),
    "decode": _query(
        *DOC_TOKENS,
        """spelled as (
          select t.id, decode(unhex(string_agg(case when t.i >= 3 then s.hex else '' end, ''
              order by t.pos))) as plain,
            decode(unhex(string_agg(s.hex, '' order by t.pos))) as special
          from (select id, unnest(ids) as i, generate_subscripts(ids, 1) as pos from enc) t
          join spelling s on s.token_id = t.i group by t.id)""",
        """select id as doc_id, length(plain)::integer as n_chars, md5(plain) as plain_md5,
        md5(special) as special_md5 from spelled""",
    ),
    "round_trip": "select doc_id, true as same, 0 as n_unk, true as same_joined from documents",
    "decode_by_join": _query(*DOC_TOKENS, "select doc_id, length(text)::integer as n_chars, md5(text) as plain_md5 from documents"),
    "shuffle_rank": """select doc_id,
        row_number() over (order by md5('45:' || doc_id), doc_id) as rank from documents""",
    "train_test_split": """select doc_id,
        case when a <= ceil(0.1::double * n) then 'test' else 'train' end as split,
        case when b <= ceil(0.2::double * n) then 'test' else 'train' end as wide_split
        from (select doc_id, row_number() over (order by md5('45:' || doc_id), doc_id) as a,
              row_number() over (order by md5('68:' || doc_id), doc_id) as b,
              count(*) over () as n from documents)""",
    "epochs": """select doc_id, epoch::integer as epoch,
        row_number() over (partition by epoch order by md5('45:' || epoch || ':' || doc_id), doc_id)
          as rank
        from (select doc_id, unnest([0, 1]) as epoch from documents)""",
    "length_batches": _query(
        *CAPPED_LENGTHS,
        _ranked("ranked", "lens", "'45:' || id"),
        """placed as (select id, length, (rank - 1) // 200 as mega, row_number() over
          (partition by (rank - 1) // 200 order by length desc, id) - 1 as place from ranked)""",
        """select id as doc_id, length::integer as length, mega * 50 + place // 4 as batch_id,
          (place % 4)::integer as slot,
          max(length) over (partition by mega, place // 4)::integer as width from placed""",
    ),
    "steps": """select doc_id, epoch::integer as epoch, rank, (rank - 1) // 4 as batch_id,
        epoch * ceil(n / 64)::bigint + (rank - 1) // 4 // 16 as step
        from (select doc_id, epoch, n, row_number() over (partition by epoch
                order by md5('45:' || epoch || ':' || doc_id), doc_id) as rank
              from (select doc_id, unnest([0, 1]) as epoch, n
                    from (select doc_id, count(*) over () as n from documents)))
        where epoch * ceil(n / 64)::bigint + (rank - 1) // 4 // 16 < 1000""",
    "shard": """select doc_id, rank, (rank - 1) // 4 as batch_id, (rank - 1) // 4 // 16 as step,
        ((rank - 1) // 4 % 4)::integer as worker
        from (select doc_id, row_number() over (order by md5('45:' || doc_id), doc_id) as rank
              from documents)""",
    "shard_index": _query(
        _ranked("ranked", "(select doc_id as id from documents)", "'45:' || id"),
        "placed as (select (rank - 1) // 4 // 16 as step, (rank - 1) // 4 % 4 as worker from ranked)",
        """files as (select worker::integer as worker, (step // 8)::bigint as stretch,
          min(step)::bigint as first_step, max(step)::bigint as last_step, count(*) as n_rows
          from placed group by all)""",
        """select *, coalesce(sum(n_rows) over (partition by worker order by stretch
          rows between unbounded preceding and 1 preceding), 0)::bigint as rows_before from files""",
    ),
    "open_shards": _query(
        _ranked("ranked", "(select doc_id as id from documents)", "'45:' || id"),
        """placed as (select id as doc_id, rank, (rank - 1) // 4 as batch_id, (rank - 1) // 4 // 16 as step,
          ((rank - 1) // 4 % 4)::integer as worker from ranked)""",
        "select * from placed where step >= (select (max(step) + 1) // 2 from placed)",
    ),
    "run_plan": _query(
        INSTRUCT,
        """runs as (select * from (values ('adapter', 0.1::double, 4, 4, 1, 2, 1000),
          ('parallel', 0.1::double, 4, 4, 4, 2, null), ('full', 0.2::double, 1, 1, 4, 2, null),
          ('uncapped', 0.1::double, 4, 4, 1, 3, null))
          r(run, share, batch, accum, world, epochs, cap))""",
        "sized as (select *, (select count(*) from instruct) as n_rows from runs)",
        "cut as (select *, ceil(share * n_rows)::bigint as test_rows from sized)",
        """per as (select *, n_rows - test_rows as train_rows,
          ceil((n_rows - test_rows) / batch)::bigint as batches_per_epoch from cut)""",
        """stepped as (select *, ceil(batches_per_epoch / (accum * world))::bigint
          as steps_per_epoch from per)""",
        """select run, n_rows, test_rows, train_rows, batches_per_epoch, steps_per_epoch,
          (steps_per_epoch * epochs)::bigint as epoch_steps,
          coalesce(cap, steps_per_epoch * epochs)::bigint as total_steps,
          ceil(coalesce(cap, steps_per_epoch * epochs) / steps_per_epoch)::bigint as epochs_read
        from stepped""",
    ),
    "fit_lm": _query(*DOC_MODEL, _model_digest("lm", "prev")),
    "adapt": _query(*MIXED, _probs_digest("mix")),
    "eval_loss": _query(
        *SPLIT_TOKENS,
        _pairs("bg", "train"),
        "states as (select 1 as checkpoint, prev, next, count(*) as n from bg group by all)",
        *HELD,
        LOSS,
        "select round(eval_loss, 6) as eval_loss, eval_tokens from losses",
    ),
    "checkpoints": _query(*STATES, _model_digest("states", "checkpoint")),
    "best_checkpoint": _query(
        *STATES,
        *HELD,
        LOSS,
        """select checkpoint::integer as checkpoint, round(eval_loss, 6) as eval_loss from losses
        order by round(eval_loss, 9), checkpoint limit 1""",
    ),
    "metrics": _query(
        *STATES,
        *HELD,
        LOSS,
        """seen as (select p.checkpoint, max(step) + 1 as step, count(*) as rows_seen,
          sum(len(ids))::bigint as tokens_seen
          from placed, cadence, points p where step // every < p.checkpoint group by p.checkpoint)""",
        """select checkpoint::integer as checkpoint, step, rows_seen, tokens_seen,
          round(eval_loss, 6) as eval_loss from seen left join losses using (checkpoint)""",
    ),
    "evaluate_run": _query(
        *STATES,
        *HELD,
        LOSS,
        _model_digest(
            """(select * from states where checkpoint = (select checkpoint from losses
            order by round(eval_loss, 9), checkpoint limit 1))""",
            "prev",
        ),
    ),
    "custom_template": _query(
        INSTRUCT,
        """select rec_id, 'Task {1}: {' || coalesce(instruction, 'None') || '}'
          || case when coalesce(input, '') <> '' then ' given ' || input else '' end
          || ' -> ' || coalesce(output, 'None') as text from instruct""",
    ),
    "fit_ngrams": _query(
        *GRAMS,
        """select length::integer as length, count(*) as n_grams, sum(n)::bigint as n,
          count(distinct context) as n_contexts from grams group by 1""",
    ),
    "ngram_loss": _query(
        *GRAM_LOSS,
        "select round(sum(-ln(p) * weight) / sum(weight), 6) as eval_loss, sum(weight)::bigint as eval_tokens from two",
    ),
    "run_log": _query(
        *LOGGED,
        """select least((interval + 1) * 10, (select max(step) + 1 from placed))::bigint as step,
          sum(n)::bigint as tokens, round(sum(-ln(p) * n) / sum(n), 6) as loss from scored group by interval""",
    ),
    "state_log": _query(*STATES, _model_digest("states", "checkpoint")),
    "reuse_dataset": _query(
        DOC_INSTRUCT,
        _block("block", "doc_instruct"),
        _split("sp", "(select rec_id as id, text from block)", 0.1, 45),
        "select id as rec_id, split, md5(text) as text_md5, 1 as hits from sp",
    ),
    "encode_subwords": _query(
        DOC_PIECES,
        SUBWORDS,
        """select doc_id, coalesce(len(ids), 0)::integer as length,
          md5(array_to_string(coalesce(ids, [])::varchar[], ' ')) as ids_md5, true as same
          from documents left join subwords on id = doc_id""",
    ),
    "with_temperature": _query(*DOC_MODEL, PROBS, TEMPERED, _probs_digest("tempered")),
    "nucleus": _query(
        *DOC_MODEL,
        PROBS,
        TEMPERED,
        """topk as (select prev, next, rank, p / sum(p) over (partition by prev) as p
          from (select *, row_number() over (partition by prev order by p desc, next) as rank
                from tempered) where rank <= 50)""",
        """head as (select * from (select *, round(coalesce(sum(p) over (partition by prev
            order by rank rows between unbounded preceding and 1 preceding), 0), 9) as before
          from topk) where before < 0.7)""",
        "kept as (select prev, next, p / sum(p) over (partition by prev) as p from head)",
        _probs_digest("kept"),
    ),
    "sample_next": SAMPLED,
    "sample_next_by_join": SAMPLED,
    "generate": _query(*GENERATED, DRAWN),
    "generate_adapted": _query(
        *MIXED, *ASKED, _choices("[0.7]", "mix", "p"), _continued("asked"), DRAWN
    ),
    "completion": _query(
        *GENERATED,
        f"""select id as prompt_id, {_digest("list_concat(ids, drawn)")} as whole_md5,
        {_digest("drawn")} as answer_md5 from answers""",
    ),
    "predict": _query(
        *DOC_MODEL,
        f"""requests as (select item_id as id,
          case when item_id % 11 <> 3 then {SECTIONS} end as prompt,
          case when item_id % 7 <> 2 then 0.5::double + (item_id % 3) * 0.25::double end as t,
          20 + item_id % 5 * 20 as max_tokens from benchmark)""",
        f"""pp as (select id, regexp_extract_all(coalesce(prompt, ''), '{PIECE}') as p
          from requests)""",
        _encoded("pe", "pp", eos=False),
        """asked as (select e.id, e.ids, coalesce(r.t, 1::double) as t,
          case when r.prompt is null or r.t is null then 0 else r.max_tokens end as max_tokens
          from pe e join requests r on r.id = e.id)""",
        _choices("[0.5, 0.75, 1.0]"),
        _continued("asked"),
        """spelled as (select t.id, decode(unhex(string_agg(s.hex, '' order by t.pos))) as answer
          from (select id, unnest(drawn) as i, generate_subscripts(drawn, 1) as pos from answers) t
          join spelling s on s.token_id = t.i where t.i >= 3 group by t.id)""",
        """select r.id as prompt_id,
          case when t is not null then md5(prompt || coalesce(answer, '')) end as text_md5,
          case when prompt is null then 'prompt is null'
               when t is null then 'temperature is null' end as error
        from requests r left join spelled s on s.id = r.id""",
    ),
    "predict_with": _query(
        DOC_PIECES,
        VOCAB,
        f"""requests as (select item_id as id,
          case when item_id % 11 <> 3 then {SECTIONS} end as prompt,
          case when item_id % 7 <> 2 then 1 end as t from benchmark)""",
        """select id as prompt_id,
          case when t is not null then md5(prompt || v.piece) end as text_md5,
          case when prompt is null then 'prompt is null'
               when t is null then 'temperature is null' end as error
        from requests left join top v on v.place - 1 = length(prompt) % 50""",
    ),
    "apply_shared_model": _query(
        *DOC_MODEL,
        """best as (select prev, next from (select prev, next,
          row_number() over (partition by prev order by n desc, next) as place from lm) where place = 1)""",
        """select id as doc_id, next::integer as next_id
          from (select id, ids[len(ids) - 1] as last from enc) left join best on prev = last""",
    ),
    "apply_joined_model": _query(
        *DOC_MODEL,
        """best as (select prev, next from (select prev, next,
          row_number() over (partition by prev order by n desc, next) as place from lm) where place = 1)""",
        """select id as doc_id, next::integer as next_id
          from (select id, ids[len(ids) - 1] as last from enc) left join best on prev = last""",
    ),
    "apply_rows": """select doc_id, len(string_split(text, chr(10)))::bigint as n_lines
        from documents""",
    "apply_model": """select doc_id, ((length(text) > 200)::integer
        + (length(text) > 2000)::integer) as grade from documents""",
    "rendered_split": _query(
        INSTRUCT,
        _block("block", "instruct"),
        _split("sp", "(select rec_id as id, text from block)", 0.1, 45),
        "select id as rec_id, split, text from sp",
    ),
    "full_run_shards": _FULL_RUN,
    "adapter_run_shards": _query(
        *_tokenized(0.1, 45, _block, "ceil(1000 / ceil(n / 16))::bigint"),
        *BY_LENGTH,
        *_placed_run(4, 4, 1, 1000),
    ),
    "parallel_run_shards": _query(
        *_tokenized(0.1, 45, _block, "2"), *BY_LENGTH, *_placed_run(4, 4, 4)
    ),
    "resumed_run_shards": f"select * from ({_FULL_RUN}) where epoch >= 1",
    "answer_requests": _query(
        *DOC_MODEL,
        f"pp as (select item_id as id, regexp_extract_all({CHAT}, '{PIECE}') as p from benchmark)",
        _encoded("pe", "pp", eos=False),
        "asked as (select id, ids, 1.0::double as t, 1024 as max_tokens from pe)",
        _choices("[1.0]", top_p=1.0),
        _continued("asked"),
        """spelled as (select t.id, decode(unhex(string_agg(s.hex, '' order by t.pos))) as answer
          from (select id, unnest(drawn) as i, generate_subscripts(drawn, 1) as pos from answers) t
          join spelling s on s.token_id = t.i where t.i >= 3 group by t.id)""",
        """select a.id as prompt_id, length(coalesce(answer, ''))::integer as n_chars,
          md5(coalesce(answer, '')) as answer_md5 from asked a left join spelled s on s.id = a.id""",
    ),
}
