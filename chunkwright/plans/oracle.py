"""DuckDB SQL for the registered queries: the same results computed a second,
independent way (recursive CTEs for the chunkers, json_each for answers).

Every query is one statement over the pre-registered tables. Shared stages
are CTE fragments; `sql(*ctes, final)` joins them into one WITH RECURSIVE.
"""

from __future__ import annotations

from chunkwright import params as P

BACKSLASH, QUOTE = "\\", '"'


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(vals) -> str:
    return "(" + ", ".join(_q(v) for v in vals) + ")"


def strip(x: str) -> str:
    """Python str.strip() in RE2."""
    return rf"regexp_replace({x}, '^[\s\x0b\x1c-\x1f\x85\pZ]+|[\s\x0b\x1c-\x1f\x85\pZ]+$', '', 'g')"


def none_like(x: str) -> str:
    return f"lower({x}) in {_list(P.NONE_LIKE)}"


SECTIONS = _list(P.SECTIONS)
TEXT_SECTIONS = _list(P.TEXT_SECTIONS)
MAP_SECTIONS = _list(P.MAP_SECTIONS)

REL_PATH = """concat(source,'/',lang,'/',
  case when doc_id%7=0 then 'Test_' when doc_id%11=0 then 'latest' else 'doc_' end, doc_id,
  case when doc_id%5=0 then '.txt' when doc_id%13=0 then '.PY' else '.py' end)"""

FILES = f"""files as (
  select doc_id, source, text, rel_path, list_last(string_split(rel_path,'/')) as file_name,
         length(text)::bigint as n_chars
  from (select *, {REL_PATH} as rel_path from documents))"""

KEPT = """kept as (
  select * from files where ends_with(file_name, '.py') and not contains(lower(file_name), 'test'))"""

PRETOKEN = r"' ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+'"


def token_count(x: str) -> str:
    return f"len(regexp_extract_all({x}, {PRETOKEN}))::bigint"


def ratio(sample: str) -> str:
    t = token_count(sample)
    return f"case when {t}=0 then 2.5 else (length({sample})::double/{t})*0.75 end"


def budget(sample: str, tokens: int) -> str:
    return f"greatest(floor({float(tokens)}*({ratio(sample)}))::bigint, 1)"


def _word_next(a: str, m: str) -> str:
    def rpos(ch):
        return f"coalesce(nullif(instr(reverse(substr(text,{a}+1,{m}+1)),{ch}),0),1000000000)"
    pos = f"least({rpos(chr(39) + ' ' + chr(39))}, {rpos('chr(10)')})"
    return f"case when {a}+{m}>=length(text) then length(text) when {pos}>{m} then {a}+{m} else {a}+{m}+1-{pos} end"


def _line_next(a: str, m: str) -> str:
    p = f"instr(reverse(substr(text,{a}+1,{m})),chr(10))"
    return f"case when {a}+{m}>=length(text) then length(text) when {p}=0 then {a}+{m} else {a}+{m}+1-{p} end"


def chunks_cte(name: str, src: str, m: str, kind: str = "word", carry: str = "doc_id, source") -> str:
    """Chunks of `src` (needs rel_path, text and the carry columns); `m` is an
    integer or a column of src. Adds n_chunks and gated."""
    nxt = _word_next if kind == "word" else _line_next
    return f"""{name}_b as (
  select rel_path, {carry}, text, {m}::bigint as m, 0::bigint as chunk_no, 0::bigint as s,
         ({nxt('0', f'({m})')})::bigint as e
  from {src} where length(text)>0
  union all
  select rel_path, {carry}, text, m, chunk_no+1, e, ({nxt('e', 'm')})::bigint from {name}_b where e<length(text)),
{name} as (
  select rel_path, {carry}, chunk_no, substr(text, s+1, e-s) as chunk_text,
         count(*) over (partition by rel_path) as n_chunks,
         (length({strip('substr(text, s+1, e-s)')})=0 or length(substr(text, s+1, e-s))<10) as gated
  from {name}_b)"""


WORD_HINT = "trim(regexp_replace(chunk_text,'[^A-Za-z ,]','','g'))"


def summary_attempts_cte(name: str, src: str, n: int = 5, with_errors: bool = False) -> str:
    err = "case when (doc_id+a)%17=0 then 'timeout' end" if with_errors else "null::varchar"
    return f"""{name} as (
  select rel_path, chunk_no, doc_id, a::bigint as attempt,
   case (doc_id+chunk_no+3*a)%8
   when 0 then concat('Here you go: {{"Overall Summary": " ',w,' ", "Data Inputs": "',source,'", "Module/Library Name": "m',chunk_no%4,', ',source,
     '", "Interfaces/APIs": "None", "Classes": {{"K',chunk_no%3,'": "',source,'", "Kx": "N/A"}}, "Configuration/Environment Variables": {{"E',chunk_no%5,'": " ',length(chunk_text),' chars "}}}} ')
   when 1 then concat('{{"Overall Summary": "',w,'", "Data Inputs": "n/a", "Data Structures": "list of ',length(chunk_text),'", "Error Handling/Logging": "',w,
     '", "Functions/Methods": {{"f',chunk_no%2,'": "',source,' c',chunk_no,'"}}}}')
   when 2 then '{{"Overall Summary": "u", "Bogus": "x"}}'
   when 3 then '{{"Overall Summary": ["l"]}} hope this helps'
   when 4 then '{{"Overall Summary": "trunc'
   when 5 then 'Sorry, I cannot do that.'
   when 6 then '{{}}'
   else concat('{{"Variables": {{"v": "1"}}, "ETL Processes": "", "Data Outputs": "',source,', ',source,'", "Interfaces/APIs": "call ',chunk_no,', ',w,
     '", "Classes": {{"K0": {{"Description": "',source,'"}}}}, "Configuration/Environment Variables": "see ',source,'"}}') end as response,
   {err} as error
  from (select *, {WORD_HINT} as w from {src}) c, range(1, {n + 1}) r(a))"""


def comment_attempts_cte(name: str, src: str, n: int = 3) -> str:
    resp = f"""concat('\"\"\"', w, '\"\"\"', chr(10), 'def part_', chunk_no, '():', chr(10), '    return ''', source, '''', chr(10))"""
    err = "case when (doc_id+chunk_no+a)%5=0 then 'rate limit' end"
    missing = f"({err}) is null and (doc_id+2*chunk_no+a)%23=0"
    return f"""{name} as (
  select rel_path, chunk_no, doc_id, a::bigint as attempt,
    case when ({err}) is null and not ({missing}) then {resp} end as response,
    {err} as error
  from (select *, {WORD_HINT} as w from {src}) c, range(1, {n + 1}) r(a))"""


def stub_answer(chunk: str = "chunk_text") -> str:
    """The offline stand-in's summary of a chunk: first six words, number of
    words (as Python splits them) and of lines."""
    words = rf"list_filter(string_split_regex({chunk}, '[\s\x0b\x1c-\x1f\x85\pZ]+'), lambda x: x <> '')"
    first = f"replace(replace(array_to_string(({words})[1:6], ' '), {_q(BACKSLASH)}, ' '), {_q(QUOTE)}, chr(39))"
    lines = f"length({chunk}) - length(replace({chunk}, chr(10), '')) + 1"
    return f"""concat('{{"Overall Summary": "', {first}, '", "Data Inputs": "', len({words}), ' words", "Data Outputs": "', {lines}, ' lines"}}')"""


def parsed_cte(name: str, src: str) -> str:
    r = rf"regexp_replace(regexp_replace({strip('response')},'(\}})\s+','\1','g'),'\s+(\{{)','\1','g')"
    incomplete = (
        f"case when response is null then null when {r}='' then false when right({r},1)<>'}}' then true "
        f"else length({r})-length(replace({r},'{{',''))<>length({r})-length(replace({r},'}}','')) end"
    )
    return f"""{name}_x as (
  select *, regexp_extract(response, '(?s)\\{{.*\\}}') as extracted from {src}),
{name}_j as (
  select *, case when json_valid(nullif(extracted,'')) then extracted end as json_text from {name}_x),
{name} as (
  select *,
    case when error is not null or response is null then 'error'
         when json_text is null or len(json_keys(json_text))=0 then 'empty'
         when len(list_filter(json_keys(json_text), lambda k: not list_contains({_pylist(P.SECTIONS)}, k)))>0 then 'bad_keys'
         when exists(select 1 from json_each(json_text) j where j.type not in ('VARCHAR','OBJECT')) then 'bad_types'
         else 'valid' end as status,
    case when json_text is null then null else len(json_keys(json_text))::bigint end as n_keys,
    {incomplete} as incomplete
  from {name}_j)"""


def _pylist(vals) -> str:
    return "[" + ", ".join(_q(v) for v in vals) + "]"


def outcomes_cte(name: str, src: str, max_attempts: int = 5) -> str:
    w = f"attempt<={max_attempts}"
    return f"""{name} as (
  select rel_path, chunk_no,
    count(*) filter (where {w})::bigint as tries,
    min(attempt) filter (where {w} and status='valid')::bigint as win,
    arg_min(json_text, attempt) filter (where {w} and status='valid') as json_text,
    min(attempt) filter (where {w} and status='error')::bigint as first_error,
    coalesce(sum(case when status in ('bad_keys','bad_types') and incomplete then 1 else 0 end) filter (where {w}), 0)::bigint as growth
  from {src} group by rel_path, chunk_no)"""


def text_values(src: str) -> str:
    """Exploded top-level string entries of json_text records in src."""
    return f"""select rel_path, chunk_no, j.key as section, {strip("(j.value->>'$')")} as val, j.type
      from {src}, json_each(json_text) j where json_text is not null"""


def merge_text_sql(src: str) -> str:
    return f"""select rel_path, section,
  rtrim(array_to_string(list_transform(list_sort(list_transform(list_distinct(l),
        lambda x: {{'i': list_position(l, x), 'x': x}})), lambda z: z.x), ', '), ', ') as value
from (select rel_path, section, string_split(string_agg(val, ', ' order by chunk_no), ', ') as l
      from ({text_values(src)})
      where type='VARCHAR' and section in {TEXT_SECTIONS} and not ({none_like('val')})
      group by rel_path, section)"""


def sql(*ctes: str, final: str) -> str:
    return "with recursive\n" + ",\n".join(ctes) + "\n" + final


def sql_str(s: str) -> str:
    return _q(s)


def outcomes_failed(src: str) -> str:
    return f"select * from {src} where first_error is not null and (win is null or first_error < win)"


def centre(text: str, n: int) -> str:
    return f"case when length({text})<={n} then {text} else substr({text}, (floor(length({text})/2) - {n // 2} + 1)::bigint, {n}) end"


def splitlines(x: str) -> str:
    parts = rf"string_split_regex({x}, '\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{{2028}}\x{{2029}}]')"
    return f"case when {parts}[-1]='' then {parts}[1:len({parts})-1] else {parts} end"


def merge_maps_sql(src: str) -> str:
    val = f"case when i.type='VARCHAR' then {strip(chr(40) + 'i.value->>' + chr(39) + '$' + chr(39) + chr(41))} else i.value::varchar end"
    return f"""select rel_path, section, item, (row_number() over (partition by rel_path, section order by o) - 1)::bigint as item_no, val as value
from (select rel_path, section, item, arg_min(val, o) as val, min(o) as o
      from (select rel_path, chunk_no, s.key as section, i.key as item, chunk_no*1000000000 + i.id as o, {val} as val
            from {src}, json_each(json_text) s, json_each(s.value) i
            where json_text is not null and s.type='OBJECT' and s.key in {MAP_SECTIONS})
      where not ({none_like('val')}) group by rel_path, section, item)"""


def replace_ext(path: str, ext: str) -> str:
    return rf"concat(regexp_replace({path}, '^((?:.*/)?\.*[^/.][^/]*)\.[^./]*$', '\1'), {_q(ext)})"


def esc(x: str) -> str:
    return f"replace(replace(replace({x}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def attr(x: str) -> str:
    return f"replace({esc(x)}, '\"', '&quot;')"
