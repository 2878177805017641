"""Mentions, bindings, claims, sections and offsets over prose made from columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.functions import mentions, text
from quire.operators import relations, sections
from quire.plans.catalogue import query

PROSE = "concat('Compound ', p_partkey, ' was used as host, EQE of ', p_size, ' % at ', p_size + 2, ' V.')"
FORMS = ["1.5", "2 x 10^3", "7×10²", "-4e2", "3X10-2", "n/a"]
UNITS = ["cd / m²", "MA/cm2", "lm / W", "cd*m-2", "EV", "°C"]


def prose(t) -> DataFrame:
    return t.spread("part", "p_partkey", "p_name", "p_size").withColumn("text", F.expr(PROSE))


def read(t) -> DataFrame:
    return prose(t).withColumn("entities", mentions.entities(F.col("text")))


def listed(t, type_: str) -> DataFrame:
    df = text.exploded(read(t), F.filter("entities", lambda e: e["type"] == type_), "e", "p_partkey")
    return df.select("p_partkey", "e.value", "e.start", "e.end")


def element(items: list[str], by: str) -> str:
    return f"element_at(array({', '.join(repr(x) for x in items)}), cast({by} % {len(items)} as int) + 1)"


def sql_element(items: list[str], by: str) -> str:
    return f"([{', '.join(repr(x) for x in items)}])[{by} % {len(items)} + 1]"


@query("select p_partkey, upper(regexp_replace(concat(p_name, '-', p_brand), '[^A-Za-z0-9]+', '', 'g')) as alias_key from part")
def alias_key_normalize(t):
    return t.part.select("p_partkey", text.alias_key(F.concat("p_name", F.lit("-"), "p_brand")).alias("alias_key"))


@query("select p_partkey, concat('mat:RAW', upper(substr(sha1(lower(trim(p_name))), 1, 12))) as canonical_id from part")
def fallback_canonical_id(t):
    return t.part.select("p_partkey", text.fallback_id(F.col("p_name")).alias("canonical_id"))


_HEAD = "length(concat('Compound ', p_partkey, ' was used as host, EQE of '))"


@query(f"""
select p_partkey, cast(p_size as varchar) as value, '%' as unit, cast(p_size as double) as value_num, cast({_HEAD} as int) as start,
       cast({_HEAD} + length(concat(p_size, ' %')) as int) as "end" from part
union all
select p_partkey, cast(p_size + 2 as varchar), 'V', cast(p_size + 2 as double), cast({_HEAD} + length(concat(p_size, ' % at ')) as int),
       cast({_HEAD} + length(concat(p_size, ' % at ', p_size + 2, ' V')) as int) from part""")
def value_unit_mentions(t):
    df = text.exploded(read(t), F.filter("entities", lambda e: e["type"] == "value"), "e", "p_partkey")
    return df.select("p_partkey", "e.value", "e.unit", "e.value_num", "e.start", "e.end")


@query("""
select p_partkey, concat('Compound ', p_partkey) as value, 0 as start, cast(length(concat('Compound ', p_partkey)) as int) as "end" from part
union all
select p_partkey, 'EQE', cast(length(concat('Compound ', p_partkey, ' was used as host, ')) as int),
       cast(length(concat('Compound ', p_partkey, ' was used as host, EQE')) as int) from part""")
def material_mentions(t):
    return listed(t, "material")


@query("""
select p_partkey, 'host' as value, cast(length(concat('Compound ', p_partkey, ' was used as ')) as int) as start,
       cast(length(concat('Compound ', p_partkey, ' was used as host')) as int) as "end" from part""")
def role_mentions(t):
    return listed(t, "role")


@query("""
select p_name, count(*) as mentions, cast(sum(p_size) as bigint) as total, min(p_size) as least, max(p_size) as most, round(avg(cast(p_size as double)), 6) as mean
from part group by p_name""")
def metric_value_binding(t):
    """The flagship: values with units, containment in sentences, the nearest metric before, an aggregate by name."""
    df = text.exploded(relations.bind(read(t)), F.filter("relations", lambda r: r["type"] == "has_value"), "r", "p_name", "entities")
    value = F.get("entities", F.col("r.target"))["value_num"].cast("int")
    return (
        df.select("p_name", value.alias("v"))
        .groupBy("p_name")
        .agg(
            F.count(F.lit(1)).alias("mentions"), F.sum(F.col("v").cast("long")).alias("total"), F.min("v").alias("least"), F.max("v").alias("most"),
            F.round(F.avg(F.col("v").cast("double")), 6).alias("mean"),
        )
    )


@query("""
select p_partkey, 'has_value' as type, 'eqe' as source, cast(p_size as varchar) as target, 'metric_unit_match' as rule, 0.85::double as confidence, 7 as distance from part
union all
select p_partkey, 'has_role', concat('Compound ', p_partkey), 'host', 'pattern_material_as_role', 0.93::double, cast(length(concat('Compound ', p_partkey, ' was used as ')) as int) from part""")
def role_binding_stages(t):
    df = text.exploded(relations.bind(read(t)), F.col("relations"), "r", "p_partkey", "entities")
    value = lambda end: F.get("entities", F.col(f"r.{end}"))["value"].alias(end)
    return df.select("p_partkey", "r.type", value("source"), value("target"), "r.rule", "r.confidence", "r.distance")


@query("""
with p as (select p_partkey, p_name, upper(replace(p_brand, '#', '')) as abbr from part)
select p_partkey, p_name as alias, abbr as canonical from p union all select p_partkey, abbr, abbr from p""")
def alias_pairs(t):
    sentence = F.concat("p_name", F.lit(" ("), F.upper(F.replace("p_brand", F.lit("#"), F.lit(""))), F.lit(")"))
    return t.part.select("p_partkey", F.explode(mentions.alias_pairs(sentence)).alias("a")).select("p_partkey", "a.alias", "a.canonical")


@query(f"""
select p_partkey, case {sql_element(UNITS, 'p_partkey')} when 'cd / m²' then 'cd/m2' when 'MA/cm2' then 'mA/cm2' when 'lm / W' then 'lm/W'
       when 'cd*m-2' then 'cd/m2' when 'EV' then 'eV' else '°C' end as unit from part""")
def unit_normalize(t):
    return t.part.select("p_partkey", text.normal_unit(F.expr(element(UNITS, "p_partkey"))).alias("unit"))


@query("""
select p_partkey, case p_partkey % 6 when 0 then 1.5 when 1 then 2000.0 when 2 then 700.0 when 3 then -400.0 when 4 then 0.03 end::double as number from part""")
def number_parse(t):
    return t.part.select("p_partkey", F.round(text.parse_number(F.expr(element(FORMS, "p_partkey"))), 9).alias("number"))


_SPANS = """
with s as (select {key}, regexp_extract_all({text}, '{pattern}') as m, string_split_regex({text}, '{pattern}') as p from {table}),
r as (select {key}, m, p, unnest(generate_series(1, len(m))) as i from s where len(m) > 0),
spans as (select {key}, i, m[i] as value, cast(coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) as int) as start from r)
"""


@query(_SPANS.format(key="doc_id", text="text", pattern="[0-9]+", table="documents") + 'select doc_id, value, start, cast(start + length(value) as int) as "end" from spans')
def number_mentions_spans(t):
    return t.documents.select("doc_id", F.explode(text.spans(F.col("text"), "[0-9]+")).alias("s")).select("doc_id", "s.value", "s.start", "s.end")


_SENTENCES = (
    _SPANS.format(key="conv_id, turn", text="text", pattern=r"[.;]\s*", table="conversations")
    + r""", cuts as (select conv_id, turn, i, cast(start + length(value) as int) as cut from spans),
ends as (select conv_id, turn, i as n, cut as e from cuts union all
         select c.conv_id, c.turn, coalesce(k.n, 0) + 1, cast(length(c.text) as int) from conversations c
         left join (select conv_id, turn, count(*) as n from cuts group by all) k using (conv_id, turn)),
sentences as (select conv_id, turn, cast(n - 1 as int) as sentence, cast(coalesce(lag(e) over (partition by conv_id, turn order by n), 0) as int) as start, e as "end" from ends)
"""
)


def _sentences(t) -> DataFrame:
    df = t.spread("conversations", "conv_id", "turn", "text").select("conv_id", "turn", "text", F.posexplode(text.sentences(F.col("text"))).alias("sentence", "s"))
    return df.select("conv_id", "turn", "text", "sentence", "s.start", "s.end")


@query(_SENTENCES + 'select conv_id, turn, sentence, start, "end" from sentences')
def sentence_split(t):
    return _sentences(t).drop("text")


@query(_SENTENCES + r"""select s.conv_id, s.turn, sentence, count(*) as words from sentences s join conversations c using (conv_id, turn),
unnest(regexp_extract_all(substr(c.text, s.start + 1, s."end" - s.start), '\S+')) as w group by all""")
def range_containment(t):
    """Words within sentences: an equi-join on the text, with the spans as a residual condition."""
    words = t.spread("conversations", "conv_id", "turn", "text").select("conv_id", "turn", F.explode(text.spans(F.col("text"), r"\S+")).alias("w")).select("conv_id", "turn", F.col("w.start").alias("a"), F.col("w.end").alias("b"))
    inside = _sentences(t).drop("text").join(words, ["conv_id", "turn"]).where("a >= start and b <= end")
    return inside.groupBy("conv_id", "turn", "sentence").agg(F.count(F.lit(1)).alias("words"))


@query("""
with c as (select o_orderkey, cast(o_orderkey % 5 + 1 as int) as a, cast(o_orderkey % 5 + 1 + o_orderkey % 3 as int) as b from orders)
select o_orderkey, cast(o_orderkey as int) as claim_no, concat('The device of claims ', a, ' to ', b) as claim_text,
       array_to_string(list_transform(list_filter(generate_series(a, b), lambda x: x <> o_orderkey), lambda x: cast(x as varchar)), ',') as depends_on from c""")
def claim_parse(t):
    line = F.expr("concat(o_orderkey, '. The device of claims ', o_orderkey % 5 + 1, ' to ', o_orderkey % 5 + 1 + o_orderkey % 3)")
    no = text.claim_no(F.col("line"))
    depends = F.array_join(F.transform(text.claim_depends(F.col("line"), no), lambda x: x.cast("string")), ",")
    return t.orders.select("o_orderkey", line.alias("line")).select("o_orderkey", no.alias("claim_no"), text.claim_text(F.col("line")).alias("claim_text"), depends.alias("depends_on"))


@query("""
select p_partkey, case p_partkey % 4 when 0 then cast(p_partkey as varchar) when 1 then 'A' when 2 then concat('B-', p_size) end as example_id, p_partkey % 4 <> 3 as heading from part""")
def example_ids(t):
    line = F.expr("case p_partkey % 4 when 0 then concat('Example ', p_partkey, ' of a device') when 1 then 'Comparative Example A' when 2 then concat('实施例 B-', p_size, ' 制备') else concat('see example ', p_size) end")
    return t.part.select("p_partkey", text.example_id(line).alias("example_id"), text.is_example_heading(line).alias("heading"))


@query("""
select p_partkey, case p_partkey % 3 when 0 then concat(p_size, 'a') end as figure_no, case p_partkey % 3 when 1 then cast(p_size as varchar) end as table_no from part""")
def caption_numbers(t):
    line = F.expr("case p_partkey % 3 when 0 then concat('Fig. ', p_size, 'a stack') when 1 then concat('TABLE ', p_size, ' results') else 'no number' end")
    return t.part.select("p_partkey", text.figure_no(line).alias("figure_no"), text.table_no(line).alias("table_no"))


@query("""
select p_partkey, cast(floor(p_size * 600 / 1000.0) as int) as x0, cast(floor(p_size * 2 * 800 / 1000.0) as int) as y0, cast(floor((p_size + 100) * 600 / 1000.0) as int) as x1,
       cast(floor((p_size + 200) * 800 / 1000.0) as int) as y1 from part""")
def absolute_boxes(t):
    box = text.absolute_box(F.expr("array(p_size, p_size * 2, p_size + 100, p_size + 200)"), F.lit(600), F.lit(800))
    return t.part.select("p_partkey", *(box[i].alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))))


_ITEMS = """case turn % 7 when 0 then 'Abstract' when 2 then 'Claims' when 4 then 'Background' when 5 then concat('Example ', conv_id) else 'plain words' end"""
_STATE = f"""
with i as (select conv_id, turn, {_ITEMS} as line, turn % 7 as k from conversations),
s as (select *, last_value(case k when 0 then 'abstract' when 2 then 'claims' when 4 then 'description' when 5 then 'example' end ignore nulls) over w as section,
        nullif(last_value(case k when 0 then '' when 2 then '' when 4 then 'background' end ignore nulls) over w, '') as subsection from i
      window w as (partition by conv_id order by turn rows unbounded preceding)),
b as (select *, case when k in (0, 4) then 'title' when k = 2 then 'claims_title' when k = 5 then 'example' when section = 'claims' then 'claim' when section is null then 'text' else section end as block_type from s)
"""


def _classified(t) -> DataFrame:
    items = t.conversations.select("conv_id", "turn", F.expr(_ITEMS).alias("line"), F.lit(True).alias("is_text"))
    return sections.classify(items, "conv_id", "turn", "line")


@query(_STATE + "select conv_id, turn, section, subsection, block_type from b")
def section_forward_fill(t):
    return _classified(t).select("conv_id", "turn", "section", "subsection", "block_type")


@query(_STATE + """
select conv_id, turn, nullif(last_value(case when k = 5 then concat('example_', conv_id) when k in (0, 2, 4) or section in ('claims', 'abstract') then '' end ignore nulls)
       over (partition by conv_id order by turn rows unbounded preceding), '') as example_id from b""")
def example_context(t):
    return _classified(t).select("conv_id", "turn", "example_id")


_LINES = "select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as n from documents"


@query(f"""
with l as ({_LINES})
select doc_id, cast(n - 1 as int) as idx, cast(sum(length(line) + 1) over w - 1 - length(line) as bigint) as char_start, cast(sum(length(line) + 1) over w - 1 as bigint) as char_end
from l window w as (partition by doc_id order by n rows unbounded preceding)""")
def line_char_offsets(t):
    lines = t.documents.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("idx", "text"), F.lit(True).alias("is_text"))
    return sections.char_offsets(lines).select("doc_id", "idx", "char_start", "char_end")


@query("""
select p_brand, cast(p_size as varchar) as number, arg_min(concat('the ', p_name), p_partkey) as label from part group by 1, 2""")
def first_label_map(t):
    line = F.concat(F.lit("The "), "p_name", F.lit(" ("), "p_size", F.lit(")"))
    rows = t.part.select("p_brand", F.col("p_partkey").alias("idx"), F.posexplode(mentions.reference_numerals(line)).alias("pos", "n")).select("p_brand", "idx", "pos", "n.number", "n.label")
    return sections.numeral_labels(rows, "p_brand").select("p_brand", F.explode("reference_numerals").alias("number", "label"))


@query("""
select c_custkey, concat('WO 2026/', c_custkey) as publication_number, concat('Title of ', c_name) as title, case when c_custkey % 2 = 0 then 'A Corp|B Inc' else 'C Ltd' end as applicants from customer""")
def front_page_fields(t):
    front = F.expr("""concat('(10) WO 2026/', c_custkey, '|(54) Title|of ', c_name, '|[', if(c_custkey % 2 = 0, '71', '73'), '] ', if(c_custkey % 2 = 0, 'A Corp; B Inc', 'C Ltd'))""")
    lines = t.customer.select("c_custkey", F.posexplode(F.split(front, r"\|")).alias("line_no", "line"))
    found = sections.inid_metadata(lines, "c_custkey")
    return found.select("c_custkey", "publication_number", "title", F.array_join("applicants", "|").alias("applicants"))


@query("""select page_id, concat('[a](part001/img/', page_id, '.png) [b](http://x/', page_id, ') <img src="part001/i.png">') as body from pages""")
def link_rewrite(t):
    body = F.expr("""concat('[a](img/', page_id, '.png) [b](http://x/', page_id, ') <img src="i.png">')""")
    return t.pages.select("page_id", text.rewrite_links(body, "part001/").alias("body"))


@query("""
with n as (select p_partkey, concat('Part', p_partkey % 150, '_', p_size) as name from part)
select p_partkey, name, dense_rank() over (order by p_partkey % 150, cast(split_part(name, '_', 2) as int)) as place from n""")
def natural_sort(t):
    from pyspark.sql import Window

    df = t.part.select("p_partkey", F.expr("concat('Part', p_partkey % 150, '_', p_size)").alias("name"))
    # Ranks go by group counts of the few distinct names, not by one window over all rows.
    names = df.select("name").distinct().withColumn("place", F.dense_rank().over(Window.orderBy(text.natural_key(F.col("name")))).cast("long"))
    return df.join(names, "name").select("p_partkey", "name", "place")


_SMILES = ["SMILES:CCO", "c1ccccc1", "CBP", "N/A", "CC(=O)O", "host material", "Br", "CCBr"]


@query("""
select p_partkey, case p_partkey % 8 when 0 then 'CCO' when 1 then 'c1ccccc1' when 4 then 'CC(=O)O' when 7 then 'CCBr' end as smiles from part""")
def smiles_candidates(t):
    value = F.expr(element(_SMILES, "p_partkey"))
    return t.part.select("p_partkey", text.smiles(F.lit("mat:X"), value, F.lit(None).cast("string")).alias("smiles"))
