"""The registered queries once more, as SQL over the same tables.

Written from the definitions and not from the Spark code: retrieval scores all
pairs, splits rank whole subsets, and the longest common subsequence advances a
list of thresholds word by word in a recursive query.
"""

from __future__ import annotations

WS = r"[\t-\r\x{1c}- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def clean(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x},''),'{WS}+',' ','g'))"


def strip(x: str) -> str:
    return rf"regexp_replace(coalesce({x},''),'^{WS}+|{WS}+\z','','g')"


def words(x: str) -> str:
    """Token list of an already cleaned text."""
    return f"list_filter(string_split({x},' '), lambda t: t<>'')"


def sentinels(x: str, to: str) -> str:
    return rf"regexp_replace(coalesce({x},''),'<extra_id_\p{{Nd}}+>','{to}','g')"


def repaired(x: str) -> str:
    return strip(f"replace({sentinels(x, ' ')},'  ',' ')")


def language(x: str) -> str:
    return (
        f"case when coalesce({x},'')='' then 'English' else case split_part({x},'_',1)"
        f" when 'En' then 'English' when 'De' then 'German' when 'Es' then 'Spanish' else {x} end end"
    )


def late(answer: str, n: str) -> str:
    rest = f"({words(answer)})[3:]"
    tail = f"array_to_string(list_concat({rest}[len({rest})//2+1:],{rest}[:len({rest})//2]),' ')"
    return (
        f"case when {n}%7=0 then '' when {n}%7=1 then '<extra_id_0>'"
        f" when {n}%7=2 then concat('<extra_id_0> <extra_id_1>',{tail}) else {tail} end"
    )


# -- corpora ---------------------------------------------------------------------

_BLANKS = "concat(' ',chr(9),chr(10),chr(11),chr(12),chr(13))"

RAW = rf"""bare as (
 select *, ltrim(substr(t,length(line)+1),{_BLANKS})='' as single from
  (select *, string_split(t,chr(10))[1] as line from (select *, ltrim(text,{_BLANKS}) as t from documents))),
heads as (
 select *, case when single then regexp_extract(line,'\A[^\x09-\x0D\x20]+') else line end as first from bare),
raw as (
 select doc_id, concat('ID_',doc_id) as ID, first as input,
  case when single and ltrim(substr(line,length(first)+1),{_BLANKS})='' then first
   when single then substr(line,length(first)+1) else substr(t,length(first)+1) end as output,
  concat(upper(substr(lang,1,1)),substr(lang,2),'_',
   case when cast(substr(source,4) as int)%2=0 then 'Aaa' else 'Bbb' end) as subset
 from heads)"""

QA = f"""{RAW}, cleaned as (select doc_id, ID, {clean('input')} as input, {clean('output')} as output, subset from raw),
qa as (select *, {late('output', 'doc_id')} as generation,
  case when doc_id%10=8 then 'val' when doc_id%10=9 then 'test' else 'train' end as split
 from cleaned where input<>'' and output<>'')"""

DIALOGUE = f"""pairs0 as (
 select concat('C_',u.conv_id,'_',u.turn) as ID, u.text as i, a.text as o, u.conv_id+u.turn as n,
  concat(case when regexp_matches(u.text,'[äöüß]') then 'De' when regexp_matches(u.text,'[èêç]') then 'Fr'
   when regexp_matches(u.text,'[ñíó]') then 'Es' else 'En' end,
   case when u.conv_id%2=0 then '_Aaa' else '_Bbb' end) as subset
 from conversations u join conversations a on a.conv_id=u.conv_id and a.turn=u.turn+1
 where u.role='user' and a.role='assistant'),
talk as (select * from (select ID, {clean('i')} as input, {clean('o')} as output, subset, n from pairs0)
 where input<>'' and output<>''),
dialogue as (select *, {late('output', 'n')} as generation from talk)"""

METHODS = f"""{DIALOGUE}, texts as (select *, {repaired('generation')} as t from dialogue),
methods as (
 select ID, subset, output, 'echo' as method, input as p from texts
 union all select ID, subset, output, 'generation', t from texts
 union all select ID, subset, output, 'hybrid', case when length(t)<5 then input else t end from texts)"""


def split(src: str, want: str, stratum: str = "coalesce(subset,'')") -> str:
    """CTE ``marked``: ``src`` with ``picked``, the first quota rows by seeded hash."""
    return f"""strata as (select {stratum} as s, count(*)::hugeint as n from {src} group by 1),
sized as (select *, sum(n) over () as total from strata),
wanted as (select *, ({want})::hugeint as want from sized),
shares as (select *, (n*want)//total as base, (n*want)%total as rest from wanted),
quotas as (select s, base + case when row_number() over (order by rest desc, s) <= want-(sum(base) over ()) then 1 else 0 end as quota from shares),
marked as (select r.*, row_number() over (partition by {stratum} order by md5(concat('42:',ID)), ID) <= quota as picked
 from {src} r join quotas on s={stratum})"""


def fraction(x: float) -> str:
    return f"ceil({x}::double*total)"


HOLDOUT = f"""{QA}, {split('qa', fraction(0.05))},
train as (select ID, input, output, subset from marked where not picked),
holdout as (select ID, input, output, subset from marked where picked)"""

# -- retrieval ---------------------------------------------------------------------


def grams(src: str, key: str, text: str) -> str:
    """Query of (key, gram, k): counted character n-grams of a cleaned text."""
    return f"""select {key}, gram, count(*) as k from (
  select {key}, substr(w,i,n) as gram from (
   select {key}, w, n, unnest(range(1,length(w)-n+2)) as i from (
    select {key}, concat(' ',w,' ') as w, unnest([3,4,5]) as n from (
     select {key}, unnest({words(text)}) as w from {src}))
   where length(w)>=n)) group by {key}, gram"""


def nearest(train: str, queries: str) -> str:
    """CTE ``found``: ``queries`` with answer, similarity and matched question."""
    return f"""own as (select subset from {train} where coalesce(subset,'')<>'' group by 1 having count(*)>=2),
routed as (select q.*, coalesce('='||o.subset,'*') as grp from {queries} q left join own o using (subset)),
routes as (select distinct grp from routed),
entries as (select t.ID, {clean('t.input')} as q, g.grp from {train} t join routes g on g.grp='*'
 or (g.grp='='||t.subset and t.subset in (select subset from own))),
tg as ({grams('entries', 'grp, ID', 'q')}),
sizes as (select grp, count(*) as N from entries group by 1),
idf as (select grp, gram, ln((1+N)::double/(1+df))+1 as idf from
 (select grp, gram, count(*) as df from tg group by 1,2) join sizes using (grp)),
tx as (select grp, ID, gram, k*idf as x from tg join idf using (grp, gram)),
tn as (select grp, ID, sqrt(sum(x*x)) as z from tx group by 1,2),
asked as (select grp, ID, {clean('input')} as q from routed),
qx as (select grp, ID, gram, k*idf as x from ({grams('asked', 'grp, ID', 'q')}) join idf using (grp, gram)),
qn as (select grp, ID, sqrt(sum(x*x)) as z from qx group by 1,2),
dots as (select grp, q.ID as qid, t.ID as tid, sum(q.x*t.x) as d from qx q join tx t using (grp, gram) group by 1,2,3),
sims as (select qid, tid, round(d/(qn.z*tn.z),6) as sim from dots d
 join qn on qn.ID=qid and qn.grp=d.grp join tn on tn.ID=tid and tn.grp=d.grp),
best as (select qid, tid, sim from sims qualify row_number() over (partition by qid order by sim desc, tid)=1),
lowest as (select grp, min(ID) as tid from entries group by 1),
found as (select r.* exclude (grp), t.output as answer, coalesce(b.sim,0.0) as similarity, t.input as matched_question
 from routed r left join best b on b.qid=r.ID left join lowest l on l.grp=r.grp
 join {train} t on t.ID=coalesce(b.tid,l.tid))"""


# -- scores -------------------------------------------------------------------------


def f1(common: str, a: str, b: str) -> str:
    return (
        f"case when {common}>0 then (2.0::double*({common}/({a})::double)*({common}/({b})::double))"
        f"/(({common}/({a})::double)+({common}/({b})::double)) else 0.0::double end"
    )


def overlaps(src: str, key: str) -> str:
    """CTE ``shared``: clipped overlap of token lists ``pw`` and ``rw``."""
    return f"""pc as (select {key}, w, count(*) as n from (select {key}, unnest(pw) as w from {src}) group by all),
rc as (select {key}, w, count(*) as n from (select {key}, unnest(rw) as w from {src}) group by all),
shared as (select {key}, sum(least(pc.n,rc.n))::bigint as common from pc join rc using ({key}, w) group by all)"""


def scored(src: str, key: str, prediction: str, lcs: bool = True) -> str:
    """CTE ``scores``: ``src`` with rouge1_f1 and (optionally) rougeL_f1."""
    head = f"""tok as materialized (select *, {words(clean(prediction))} as pw, {words(clean('output'))} as rw from {src}),
{overlaps('tok', key)}"""
    if not lcs:
        return head + f""",
scores as (select tok.*, coalesce(common,0) as common, {f1('coalesce(common,0)', 'len(pw)', 'len(rw)')} as rouge1_f1
 from tok left join shared using ({key}))"""
    return head + f""",
places as (select {key}, w, list(j order by j) as js from
 (select {key}, unnest(rw) as w, unnest(range(1,len(rw)+1)) as j from tok) group by all),
steps as materialized (select {key}, row_number() over (partition by {key} order by i) as s, js from
 (select {key}, unnest(pw) as w, unnest(range(1,len(pw)+1)) as i from tok) join places using ({key}, w)),
lcs as (
 select {key}, 0::bigint as s, []::bigint[] as t from tok
 union all
 select {', '.join('l.' + k.strip() for k in key.split(','))}, l.s+1,
  list_concat(list_transform(l.t, lambda x, k: coalesce(list_min(list_filter(st.js, lambda j: j<=x and j>coalesce(l.t[k-1],0))),x)),
   case when list_max(st.js)>coalesce(l.t[len(l.t)],0)
    then [list_min(list_filter(st.js, lambda j: j>coalesce(l.t[len(l.t)],0)))] else [] end)
 from lcs l join steps st on {' and '.join(f'st.{k.strip()}=l.{k.strip()}' for k in key.split(','))} and st.s=l.s+1),
longest as (select {key}, max(len(t))::bigint as lcs from lcs group by all),
scores as (select tok.*, coalesce(common,0) as common, lcs, {f1('coalesce(common,0)', 'len(pw)', 'len(rw)')} as rouge1_f1,
  {f1('lcs', 'len(pw)', 'len(rw)')} as rougeL_f1
 from tok join longest using ({key}) left join shared using ({key}))"""


MEANS = """round(coalesce(avg(rouge1_f1),0),6) as rouge1_f1, round(coalesce(avg("rougeL_f1"),0),6) as "rougeL_f1",
 round((coalesce(avg(rouge1_f1),0)+coalesce(avg("rougeL_f1"),0))*0.5::double,6) as combined"""

REAL_MEANS = """coalesce(avg(rouge1_f1),0) as rouge1_f1, coalesce(avg("rougeL_f1"),0) as "rougeL_f1",
 (coalesce(avg(rouge1_f1),0)+coalesce(avg("rougeL_f1"),0))*0.5::double as combined"""

# A CTE list with a recursive member needs the keyword once, in front.
WITH, WITH_LCS = "with ", "with recursive "


def _text(select: str) -> str:
    return f"{WITH}{RAW} {select}"


def _faulty() -> str:
    blank = f"case when {strip('generation')}='' then ' ' else {strip('generation')} end"
    odd = "case when doc_id%13=0 then concat('X',ID) else ID end"
    copies = "case when doc_id%19=0 then 0 when doc_id%17=0 then 2 else 1 end"
    return f"""{QA}, sample as (select ID, {blank} as t from qa),
faulty as (select ID, t from (select {odd} as ID, {blank} as t, unnest(range(0,{copies})) from qa)),
per_id as (select ID, sum(got)::bigint as got, sum(want)::bigint as want from
 (select ID, 1 as got, 0 as want from faulty union all select ID, 0, 1 from sample) group by 1)"""


def _submission_check() -> str:
    cols = "ID,TargetRLF1,TargetR1F1,TargetLLM"
    rules = {"missing": "got=0", "unexpected": "want=0", "duplicate": "got>1"}
    parts = [
        f"select 'columns' as \"check\", true as ok, '{cols}' as expected, '{cols}' as found, '' as examples",
        "select 'row_count', sum(want)=sum(got), sum(want)::varchar, sum(got)::varchar, '' from per_id",
    ]
    for name, rule in rules.items():
        parts.append(
            f"select '{name}', count(*)=0, '0', count(*)::varchar,"
            f" coalesce(array_to_string((list(ID order by ID))[1:3],','),'') from per_id where {rule}"
        )
    return f"{WITH}{_faulty()} " + " union all ".join(parts)


def _histogram() -> str:
    return f"""{WITH}{QA}, v as (
 select 'question' as metric, len({words('input')}) as n from qa
 union all select 'answer', least(len({words('output')}),300) from qa),
r as (select metric, min(n)-case when min(n)=max(n) then 0.5 else 0.0 end::double as lo,
 max(n)+case when min(n)=max(n) then 0.5 else 0.0 end::double as hi from v group by 1),
b as (select metric, least(floor((n-lo)*50/(hi-lo)),49)::bigint as bin, count(*) as c from v join r using (metric) group by 1,2),
f as (select metric, lo, hi, unnest(range(0,50)) as bin from r)
select metric, bin, round(lo+bin*((hi-lo)/50),6) as low, round(lo+(bin+1)*((hi-lo)/50),6) as high, coalesce(c,0) as count
from f left join b using (metric, bin)"""


def _generated(prompt: str) -> str:
    return f"case when length({prompt})%3=0 then '<extra_id_0>' else concat({prompt},' <extra_id_1>') end"


def _encoded() -> str:
    return f"""{QA}, ex as (select ID, string_split(concat({language('subset')},': ',input),' ') as pw, string_split(output,' ') as aw from qa),
vocab as (select w, row_number() over (order by n desc, case when n<=16 then md5(w) else '' end, w)+1 as wid from (
 select w, count(*) as n from (select unnest(list_concat(pw,aw)) as w from ex) group by 1)),
iw as (select ID, list(coalesce(wid,1)::int order by i) as input_ids from
 (select ID, unnest(pw[1:256]) as w, unnest(range(0,len(pw[1:256]))) as i from ex) left join vocab using (w) group by 1),
tw as (select ID, list(coalesce(wid,1)::int order by i) as labels from
 (select ID, unnest(aw[1:512]) as w, unnest(range(0,len(aw[1:512]))) as i from ex) left join vocab using (w) group by 1),
enc as (select ID, input_ids, list_transform(input_ids, lambda x: 1::int) as attention_mask, labels from iw join tw using (ID))"""


def _batches() -> str:
    def pad(c: str, width: str, fill: int) -> str:
        return f"list_concat({c}, list_transform(range(len({c}),{width}), lambda x: {fill}::int)) as {c}"

    return f"""{WITH}{_encoded()}, placed as (select *, (row_number() over (order by md5(concat('42:',ID)), ID)-1)//4 as batch from enc),
wide as (select *, (max(len(input_ids)) over (partition by batch)+7)//8*8 as iw, (max(len(labels)) over (partition by batch)+7)//8*8 as lw from placed)
select batch, ID, {pad('input_ids', 'iw', 0)}, {pad('attention_mask', 'iw', 0)}, {pad('labels', 'lw', -100)} from wide"""


CONFIGS = """base as (select event_type as key, cast(cast(floor(min(value)+1) as bigint) as varchar) as value
 from events where event_type<>'error' group by 1),
named as (select concat('run_',user_id) as run, max(props) as hypothesis from events group by 1),
given as (select concat('run_',user_id) as run, event_type as key,
 case when count(*)%3<>0 then cast(cast(floor(min(value)) as bigint) as varchar) end as value, true as present from events group by user_id, event_type),
plain as (select run, key, case when present then g.value else b.value end as value,
 case when present then 'override' else 'base' end as source, b.value as was
 from named cross join base b left join given g using (run, key))"""

RUNS = f"""{METHODS}, {scored('methods', 'ID, method', 'p')},
overall as (select method, {REAL_MEANS} from scores group by 1),
parts as (select method, subset, {REAL_MEANS} from scores group by 1,2),
maps as (select method, concat('{{', string_agg(concat('"',subset,'":',round(combined,4)), ',' order by round(combined,4), subset), '}}') as per_language from parts group by 1),
log as (select method as key, concat('Run ',method) as title, 'none' as hypothesis,
 case method when 'echo' then '{{"min_chars":null,"note":"the question"}}' when 'hybrid' then '{{"fallback":true,"min_chars":5,"style":"lang_prefix"}}' else '{{}}' end as changed_fields,
 'stub' as model_name,
 round(rouge1_f1,4) as rouge1_f1, round("rougeL_f1",4) as "rougeL_f1", round(combined,4) as combined, '' as public_lb, per_language
 from overall join maps using (method))"""

EVENT_RUNS = """er as (select concat('run_',user_id) as key, max(value) as rouge1_f1, min(value) as "rougeL_f1",
 case when user_id%97=0 then null when user_id%5=0 then floor(max(value)) else max(value) end as combined from events group by user_id)"""


def _nulled(c: str) -> str:
    tokens = (
        "'','#N/A','#N/A N/A','#NA','-1.#IND','-1.#QNAN','-NaN','-nan','1.#IND','1.#QNAN',"
        "'<NA>','N/A','NA','NULL','NaN','None','n/a','nan','null'"
    )
    return f"case when {c} in ({tokens}) then null else {c} end"


CSV = f"""{RAW}, marked_csv as (select doc_id, ID, output, subset,
 case when doc_id%50=0 then ['NA','null','None'][doc_id%3+1] else input end as input from raw),
csv as (select doc_id, ID, {clean(_nulled('input'))} as input, {clean(_nulled('output'))} as output, subset, input as i0 from marked_csv)"""


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    # text
    sql["clean_text"] = f"select doc_id, {clean('text')} as cleaned from documents"
    sql["clean_strip"] = f"select doc_id, {strip('text')} as stripped from documents"
    sql["tokenize_ws"] = f"select doc_id, {words(clean('text'))} as tokens from documents"
    letters = r"length(regexp_replace(text,'[^\p{L}]+','','g'))"
    ascii_letters = "length(regexp_replace(text,'[^A-Za-z]+','','g'))"
    latin = f"case when {letters}>0 then {ascii_letters}/{letters}::double else 0.0::double end"
    sql["latin_fraction"] = f"select doc_id, {latin} as latin from documents"
    q, lang = clean("input"), language("subset")
    sql["prompt_bare"] = _text(f"select ID, {q} as prompt from raw")
    sql["prompt_instruction"] = _text(
        f"select ID, concat('Answer this health question in ',{lang},': ',{q}) as prompt from raw"
    )
    sql["prompt_lang_prefix"] = _text(f"select ID, concat({lang},': ',{q}) as prompt from raw")
    with_reference = (
        f"concat({lang},': ',input, case when generation<>'' then concat(chr(10),'Reference: ',{clean('generation')}) else '' end)"
    )
    sql["prompt_with_reference"] = f"{WITH}{QA} select ID, {with_reference} as prompt from qa"
    sql["sentinel_cleanup"] = f"{WITH}{QA} select ID, {repaired('generation')} as text from qa"
    sql["sentinel_delete"] = (
        f"{WITH}{QA} select ID, {strip(sentinels('generation', ''))} as text from qa"
    )
    sql["subset_language"] = _text(
        f"select ID, subset, {lang} as language from (select ID, case when doc_id%11<>0 then subset end as subset from raw)"
    )
    sql["char_ngrams"] = (
        f"{WITH}{QA} select gram, count(*) as rows, sum(k)::bigint as total from ({grams('qa', 'ID', 'input')}) group by 1"
    )
    rows = "ID, input, output, subset"
    sql["drop_empty"] = f"{WITH}{QA} select {rows} from qa"
    # sources
    kept = "input<>'' and output<>''"
    sql["load_split"] = f"{WITH}{CSV} select {rows} from csv where {kept}"
    none = ", ".join(f"null::varchar as \"{c}\"" for c in ("TargetRLF1", "TargetR1F1", "TargetLLM"))
    sql["load_all"] = f"""{WITH}{CSV}
 select {rows}, case when doc_id%10=8 then 'val' else 'train' end as split, {none} from csv where doc_id%10<9 and {kept}
 union all select ID, input, null, subset, 'test', null, null, null from csv where doc_id%10=9 and input<>''
 union all select ID, null, null, null, 'sample_submission', '?', '?', '?' from csv where doc_id%10=9"""
    sql["dataset_shapes"] = f"""{WITH}{CSV}, shaped as (
 select case when doc_id%10=8 then 'val' when doc_id%10=9 then 'test' else 'train' end as split, input, output from csv)
select split, count(*) as rows, case when split='test' then 3 else 4 end::bigint as columns from shaped
where input<>'' and (output<>'' or split='test') group by split"""
    fallback = f"select ID, {repaired('generation')} as g, input from qa"
    sql["hybrid_fallback"] = (
        f"{WITH}{QA} select ID, case when length(g)<5 then input else g end as prediction, length(g)<5 as used_fallback from ({fallback})"
    )
    targets = '{0} as "TargetRLF1", {0} as "TargetR1F1", {0} as "TargetLLM"'
    sql["submission_rows"] = (
        f"{WITH}{QA} select ID, {targets.format('t')} from (select ID, case when g='' then ' ' else g end as t from ({fallback}))"
    )
    sql["submission_sink"] = (
        f"{WITH}{QA} select ID, {targets.format('t')} from (select ID, case when length(g)<5 then input else g end as t from ({fallback}))"
    )
    sql["make_submission"] = sql["submission_sink"]
    low = "('De_Aaa','Es_Aaa','Es_Bbb','Fr_Bbb')"
    sql["low_resource_rows"] = f"{WITH}{QA} select {rows} from qa where subset in {low}"
    sql["training_pairs"] = f"{WITH}{QA} select ID, {with_reference} as prompt, output as answer from qa"
    # submission checks
    sql["id_coverage"] = (
        f"{WITH}{_faulty()} select case when got=0 then 'missing' else 'unexpected' end as problem, ID from per_id where got=0 or want=0"
    )
    sql["submission_check"] = _submission_check()
    b, c = "case when length(t)%5<>0 then t end", "case when length(t)%7=0 then '?' else t end"
    sql["submission_targets_check"] = f"""{WITH}{_faulty()}, three as (select t as a, {b} as b, {c} as c from faulty),
x as (select count(*) as rows, (select count(*) from sample) as expected_rows,
 count(*) filter (where a is null or b is null or c is null) as null_targets,
 count(*) filter (where a is distinct from b or a is distinct from c) as differing_targets from three)
select *, rows=expected_rows and null_targets=0 and differing_targets=0 as ok from x"""
    # sampling
    label = "case when picked then 'holdout' else 'train' end as part"
    sql["stratified_split"] = f"{WITH}{QA}, {split('qa', fraction(0.05))} select ID, subset, {label} from marked"
    sql["holdout_rows"] = f"{WITH}{HOLDOUT} select {rows} from holdout"
    sql["stratified_cap"] = f"{WITH}{QA}, {split('qa', 'least(150,total)')} select ID, subset from marked where picked"
    sql["sample_n"] = (
        f"{WITH}{QA} select ID, subset from qa order by md5(concat('42:',ID)), ID limit 200"
    )
    copies = f"select ID, subset, unnest(range(1, case when subset in {low} then 3 else 2 end))::int as copy_no from qa"
    sql["oversample_subsets"] = f"{WITH}{QA} {copies}"
    sql["shuffle_rows"] = (
        f"{WITH}{QA} select ID, copy_no, row_number() over (order by md5(concat('42:',ID,':',copy_no)), ID, copy_no) as position from ({copies})"
    )
    # retrieval
    sql["eligible_groups"] = (
        f"{WITH}{HOLDOUT} select subset, count(*) as rows from train group by 1 having count(*)>=2"
    )
    changed = "case when subset like 'Fr%' then 'Xx_Aaa' when subset<>'De_Bbb' then subset end as subset"
    sql["retrieval_route"] = f"""{WITH}{HOLDOUT}, own as (select subset from train group by 1 having count(*)>=2)
select ID, q.subset, coalesce('='||o.subset,'*') as grp from (select ID, {changed} from holdout) q left join own o using (subset)"""
    indexed = f"""{QA}, own as (select subset from qa group by 1 having count(*)>=2),
e as (select ID, input, '='||subset as grp from qa where subset in (select subset from own) union all select ID, input, '*' from qa),
g as ({grams('e', 'grp, ID', 'input')}), n as (select grp, count(*) as N from e group by 1)"""
    sql["gram_idf"] = f"""{WITH}{indexed}, s as (select grp, gram, count(*) as df, sum(k) as tf from g group by 1,2
 qualify row_number() over (partition by grp order by tf desc, gram)<=200000)
select grp, gram, df, round(ln((1+N)::double/(1+df))+1,6) as idf from s join n using (grp)"""
    sql["vocab_topk"] = f"""{WITH}{indexed} select grp, gram, count(*) as df, sum(k)::bigint as tf from g group by 1,2
 qualify row_number() over (partition by grp order by tf desc, gram)<=2000"""
    hit = "answer, similarity, matched_question"
    sql["retrieve_nearest"] = f"""{WITH}{HOLDOUT}, asks as (select ID, input, {changed} from holdout), {nearest('train', 'asks')}
select ID, input, subset, {hit} from found"""
    sql["stored_index"] = sql["answer_stream"] = sql["retrieve_nearest"]
    sql["prediction_preview"] = f"""{WITH}{HOLDOUT}, {nearest('train', 'holdout')}
select ID, left(input,120) as question, left(output,120) as reference, left(answer,120) as prediction,
 printf('%.3f',similarity) as similarity, left(matched_question,120) as matched_question from found order by ID limit 5"""
    by_subset = f"select subset, count(*) as count, {MEANS} from scores group by subset"
    report = f"""select 'subset' as level, subset, count(*) as count, {MEANS} from scores where subset is not null group by subset
 union all select 'overall', null, count(*), {MEANS} from scores"""
    sql["retrieval_baseline"] = (
        f"{WITH_LCS}{HOLDOUT}, {nearest('train', 'holdout')}, {scored('found', 'ID', 'answer')} {report}"
    )
    wider = HOLDOUT.replace(fraction(0.05), fraction(0.1))
    sql["retrieval_ceiling"] = (
        f"{WITH_LCS}{wider}, {nearest('train', 'holdout')}, {scored('found', 'ID', 'answer')} select {MEANS} from scores"
    )
    # scores
    sql["rouge1_pairs"] = f"""{WITH}{QA}, g as (select ID, output, {repaired('generation')} as p from qa), {scored('g', 'ID', 'p', lcs=False)}
select ID, common, rouge1_f1 from scores"""
    per_method = f"{WITH_LCS}{METHODS}, {scored('methods', 'ID, method', 'p')}"
    sql["rougeL_pairs"] = f'{per_method} select ID, method, lcs as common, "rougeL_f1" from scores'
    hybrid = f"{WITH_LCS}{METHODS}, m as (select * from methods where method='hybrid'), {scored('m', 'ID, method', 'p')}"
    sql["rouge_overall"] = f"{hybrid} select {MEANS} from scores"
    sql["rouge_by_subset"] = f"{hybrid} {by_subset}"
    sql["baseline_comparison"] = (
        f"{per_method} select method, count(*) as count, {MEANS} from scores where method<>'hybrid' group by method"
    )
    # statistics
    qw, aw = f"len({words('input')})", f"len({words('output')})"
    sql["length_stats"] = f"""{WITH}{QA}, v as (select {qw} as q, {aw} as a from qa)
select round(avg(q),6) as q_mean, quantile_cont(q,0.5) as q_median, round(avg(a),6) as a_mean, quantile_cont(a,0.5) as a_median,
 round(quantile_cont(a,0.9),6) as a_p90, round(quantile_cont(a,0.99),6) as a_p99, max(a) as a_max from v"""
    sql["length_histogram"] = _histogram()
    sql["answer_uniqueness"] = (
        f"{WITH}{QA} select count(distinct output) as unique_answers, count(*) as rows, round(count(distinct output)/count(*)::double,6) as unique_ratio from qa"
    )
    sql["answer_reuse"] = f"""{WITH}{QA}, a as (select count(distinct subset) as n from qa group by output)
select count(*) filter (where n>1) as shared_answers, round(avg((n>1)::int),6) as shared_fraction from a"""
    sql["sketched_uniqueness"] = f"""{WITH}{QA}, a as (select distinct subset, output from qa where subset is not null)
select subset, count(*) as unique_answers, count(*) filter (where exists
  (select 1 from a b where b.output=a.output and b.subset<>a.subset)) as elsewhere from a group by 1
 union all select null, count(distinct output), null from a"""
    sql["top_answers"] = (
        f"{WITH}{QA} select output as answer, count(*) as rows from qa group by 1 order by rows desc, answer limit 10"
    )
    sql["script_composition"] = (
        f"{WITH}{QA} select subset, round(avg({latin.replace('text', 'output')}),6) as latin_fraction from qa group by 1"
    )
    sql["subset_distribution"] = (
        f"{WITH}{QA} select subset, "
        + ", ".join(f"count(*) filter (where split='{s}') as {s}" for s in ("train", "val", "test"))
        + " from qa group by 1"
    )
    sql["length_budget_coverage"] = f"""{WITH}{QA} select subset, count(*) as rows, round(avg(({qw}<=32)::int),6) as question_share,
 round(avg(({aw}<=256)::int),6) as answer_share from qa group by 1"""
    # prediction and encoding
    prompt = f"concat({lang},': ',input)"
    sql["batch_predict"] = f"""{WITH}{QA}, p as (select ID, {prompt} as prompt from qa)
select ID, prompt, {repaired(_generated('prompt'))} as prediction from p"""
    evaluated = f"""{WITH_LCS}{DIALOGUE}, {split('dialogue', fraction(0.2))},
train as (select {rows} from marked where not picked), holdout as (select {rows} from marked where picked),
{nearest('train', 'holdout')},
prompts as (select *, concat({lang},': ',input,case when answer<>'' then concat(chr(10),'Reference: ',{clean('answer')}) else '' end) as prompt from found),
made as (select ID, output, subset, answer, {repaired(_generated('prompt'))} as g from prompts),
final as (select ID, output, subset, case when length(g)<5 then answer else g end as p from made),
{scored('final', 'ID', 'p')}"""
    sql["evaluate_predictions"] = f"{evaluated} {report}"
    sql["evaluated_rows"] = f'{evaluated} select ID, p as prediction, rouge1_f1, "rougeL_f1" from scores'
    sql["encode_examples"] = f"{WITH}{_encoded()} select * from enc"
    sql["pad_batches"] = _batches()
    sql["decoded_scores"] = f"""{WITH}{QA} select ID, array_to_string(({words('output')})[1:512],' ') as reference, 1.0::double as rouge1_f1 from qa"""
    ids = f"select ID, list_transform({words('input')}, lambda w: (length(w)-1)::int) as ids from qa"
    sql["label_mask"] = (
        f"{WITH}{QA} select ID, list_transform(ids, lambda x: case when x=0 then -100 else x end) as labels from ({ids})"
    )
    sql["label_unmask"] = f"""{WITH}{QA} select ID, list_filter(ids, lambda x: x<>0) as labels,
 list_filter(list_transform(ids, lambda x: x-2), lambda x: x>0) as predictions from ({ids})"""
    # runs
    sql["resolve_configs"] = f"""{WITH}{CONFIGS} select run, key, value, source from plain
 union all select run, 'run_name', run, 'derived' from named
 union all select run, 'output_dir', concat('artifacts/',run), 'derived' from named
 union all select run, 'submission_path', concat('artifacts/',run,'/submission.csv'), 'derived' from named
 union all select run, 'notes', hypothesis, 'derived' from named
 union all select run, key, value, 'unknown' from given where key not in (select key from base)"""
    sql["setting_types"] = f"""{WITH}{CONFIGS}, all_settings as (select run, key, value from plain
 union all select run, 'run_name', run from named union all select run, 'output_dir', run from named
 union all select run, 'submission_path', run from named union all select run, 'notes', hypothesis from named
 union all select run, key, value from given where key not in (select key from base))
select key, case when key in ('run_name','output_dir','submission_path') then 'STRING' when value is null then 'VOID'
  when json_valid(value) then case json_type(value) when 'OBJECT' then 'OBJECT<k: BIGINT>' else 'BIGINT' end else 'STRING' end as type,
 count(*) as runs from all_settings group by 1,2"""
    pair = "concat('\"',key,'\":',coalesce(value,'null'))"
    sql["changed_fields"] = f"""{WITH}{CONFIGS}, d as (select run, string_agg({pair}, ',' order by key) as j
 from plain where value is distinct from was group by 1)
select run, concat('{{',coalesce(j,''),'}}') as changed_fields from named left join d using (run)"""
    logged = "key, title, hypothesis, changed_fields, model_name, rouge1_f1, \"rougeL_f1\", combined, public_lb, per_language"
    sql["run_log_row"] = f"{WITH_LCS}{RUNS} select {logged} from log"
    sql["run_log_append"] = sql["load_runs"] = sql["run_log_row"]
    sql["per_subset_json"] = f"{WITH_LCS}{RUNS} select * from maps"
    sql["runs_by_subset"] = f"{WITH_LCS}{RUNS} select method as key, subset, round(combined,4) as combined from parts"
    sql["rank_runs"] = f"{WITH}{EVENT_RUNS} select key, combined, rank() over (order by combined desc nulls last) as rank from er"
    sql["leaderboard_progression"] = f"""{WITH}{EVENT_RUNS}, p as (select event_id as submission, strftime(ts,'%Y-%m-%d') as date,
 concat('run_',user_id) as experiment_key, props as description, case when event_id%2=0 then value end as "public_rougeL",
 case when event_id%3=0 then value end as public_rouge1, null::double as public_llm, event_type as notes from events)
select p.*, rouge1_f1, "rougeL_f1", combined from p left join er on key=experiment_key"""
    history = """e as (select user_id, event_id, case when event_id%97=0 or event_id%89=0 then null else value end as value from events)"""
    sql["best_checkpoint"] = f"""with {history} select user_id as run,
 case when value is not null then event_id end as best_epoch, value as best_metric from e
 qualify row_number() over (partition by user_id order by value desc nulls last, event_id)=1"""
    sql["early_stop_epoch"] = f"""with {history}, h as (select user_id as run, event_id as epoch, value as metric,
 max(value) over (partition by user_id order by event_id rows between unbounded preceding and 1 preceding) as best from e),
i as (select *, count(*) filter (where metric is not null and (best is null or metric>best)) over (partition by run order by epoch) as island from h),
m as (select *, row_number() over (partition by run, island order by epoch)-(island>0)::int as misses from i)
select run, min(epoch) filter (where misses>=5) as stop_epoch from m group by 1"""
    return sql
