"""Landed records to blocks and back: tables, wire records, registry studies, model output and remote calls."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Labels of layout models by block type; the first part of a label that fits decides.
LABELS = (
    ("page_header", "header"), ("page_footer", "footer"), ("page_number", "footer"), ("footnote", "footnote"), ("caption", "caption"), ("title", "heading"), ("heading", "heading"),
    ("section", "heading"), ("list", "list"), ("table", "table"), ("figure", "figure"), ("picture", "figure"), ("image", "figure"), ("chart", "figure"), ("header", "header"),
    ("footer", "footer"), ("text", "paragraph"), ("paragraph", "paragraph"),
)
STUDY_SCHEMA = """
protocolSection struct<
  identificationModule:struct<nctId:string,briefTitle:string,officialTitle:string>,
  statusModule:struct<overallStatus:string,startDateStruct:struct<date:string>>,
  sponsorCollaboratorsModule:struct<leadSponsor:struct<name:string,class:string>,collaborators:array<struct<name:string>>>,
  conditionsModule:struct<conditions:array<string>,keywords:array<string>>,
  designModule:struct<studyType:string,phases:array<string>,designInfo:struct<allocation:string,interventionModel:string,primaryPurpose:string,maskingInfo:struct<masking:string>>,enrollmentInfo:struct<count:int,type:string>>,
  armsInterventionsModule:struct<armGroups:array<struct<label:string,type:string,description:string,interventionNames:array<string>>>,interventions:array<struct<type:string,name:string,description:string,armGroupLabels:array<string>>>>,
  outcomesModule:struct<primaryOutcomes:array<struct<measure:string,description:string,timeFrame:string>>,secondaryOutcomes:array<struct<measure:string,description:string,timeFrame:string>>>,
  eligibilityModule:struct<eligibilityCriteria:string,sex:string,minimumAge:string,maximumAge:string,healthyVolunteers:boolean>>,
documentSection struct<largeDocumentModule:struct<largeDocs:array<struct<hasProtocol:boolean,filename:string,size:bigint>>>>
"""


def block_type(label: Column) -> Column:
    """Block type of a layout label; other for unknown ones, null stays null."""
    low = F.lower(label)
    return F.when(low.isNull(), None).otherwise(F.coalesce(*(F.when(F.contains(low, F.lit(part)), F.lit(kind)) for part, kind in LABELS), F.lit("other")))


def markdown_table(rows: Column) -> Column:
    """array<array<string>> as a Markdown table: pipes escaped, short rows padded, the first row as its head."""
    width = F.aggregate(rows, F.lit(0), lambda n, r: F.greatest(n, F.size(r)))
    cell = lambda c: F.trim(F.regexp_replace(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")), r"\s*\n\s*", " "))
    line = lambda r: F.concat(F.lit("| "), F.array_join(F.concat(F.transform(r, cell), F.array_repeat(F.lit(""), (width - F.size(r)).cast("int"))), " | "), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.array_join(F.array_repeat(F.lit("---"), width.cast("int")), "|"), F.lit("|"))
    lines = F.transform(rows, line)
    return F.when(F.size(rows) > 0, F.array_join(F.concat(F.slice(lines, 1, 1), F.array(rule), F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))), "\n")).otherwise("")


def html_tables(cells: DataFrame, *key: str) -> DataFrame:
    """key, html: cells (row, col, row_span, col_span, is_header, text) as HTML tables, one per key.

    Of cells at one place the first by text stays; a cell covered by another one's span is left out. Tables bound groups.
    """
    from leafwork.functions.text import html_escape

    rs, cs = (F.greatest(F.coalesce(F.col(c), F.lit(1)), F.lit(1)) for c in ("row_span", "col_span"))
    at = cells.groupBy(*key, "row", "col").agg(F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), rs.alias("rs"), cs.alias("cs"), F.coalesce("is_header", F.lit(False)).alias("h"))).alias("c"))
    flat = at.select(*key, "row", "col", "c.*")
    over = flat.where((F.col("rs") > 1) | (F.col("cs") > 1)).select(*key, F.col("row").alias("r0"), F.col("col").alias("c0"), F.col("rs").alias("r"), F.col("cs").alias("k"))
    covered = (F.col("row") >= F.col("r0")) & (F.col("row") < F.col("r0") + F.col("r")) & (F.col("col") >= F.col("c0")) & (F.col("col") < F.col("c0") + F.col("k")) & ((F.col("row") != F.col("r0")) | (F.col("col") != F.col("c0")))
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"o.{k}")) for k in key]
    free = flat.alias("a").join(over.alias("o"), [*same, covered], "left_anti")
    tag = F.when(F.col("h"), "th").otherwise("td")
    spans = F.concat(F.when(F.col("rs") > 1, F.concat(F.lit(' rowspan="'), "rs", F.lit('"'))).otherwise(""), F.when(F.col("cs") > 1, F.concat(F.lit(' colspan="'), "cs", F.lit('"'))).otherwise(""))
    cell = F.concat(F.lit("<"), tag, spans, F.lit(">"), html_escape(F.col("text")), F.lit("</"), tag, F.lit(">"))
    rows = free.withColumn("cell", cell).groupBy(*key, "row").agg(F.array_sort(F.collect_list(F.struct("col", "cell"))).alias("cells"))
    line = rows.withColumn("line", F.concat(F.lit("<tr>"), F.array_join(F.transform("cells", lambda c: c["cell"]), ""), F.lit("</tr>")))
    table = line.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("row", "line"))).alias("rows"))
    return table.select(*key, F.concat(F.lit("<table>"), F.array_join(F.transform("rows", lambda r: r["line"]), ""), F.lit("</table>")).alias("html"))


def wire_blocks(remote: DataFrame, parser: str = "mineru") -> DataFrame:
    """Remote records as blocks: array boxes become structs (null unless they have four numbers), metadata stays JSON."""
    box = F.struct(*(F.element_at("bbox", i + 1).alias(n) for i, n in enumerate(("x0", "y0", "x1", "y1"))))
    return remote.select(
        F.col("remote_id").alias("block_id"), "doc_id", "page_num", "order_index", F.coalesce("block_type", F.lit("other")).alias("block_type"), F.coalesce("text", F.lit("")).alias("text"),
        F.when(F.size("bbox") == 4, box).alias("bbox"), F.lit(parser).alias("parser_used"), "metadata",
    )


def scaled_box(box: Column, width: Column, height: Column) -> Column:
    """A box in thousandths of the page as points."""
    return F.struct(*((box[n] * side / 1000).alias(n) for n, side in (("x0", width), ("y0", height), ("x1", width), ("y1", height))))


def tolerant_json(text: Column, schema: str) -> Column:
    """The object in model output: fences dropped, first { to last }; null if it cannot be read."""
    bare = F.regexp_replace(text, r"(?m)^\s*```[a-zA-Z]*\s*$", "")
    body = F.regexp_extract(bare, r"(?s)(\{.*\})", 1)
    return F.from_json(F.when(body != "", body), schema, {"mode": "PERMISSIVE"})


def registry_truth(studies: DataFrame) -> DataFrame:
    """Registry study records (STUDY_SCHEMA) as one flat row each; absent lists are empty, absent scalars null."""
    p = F.col("protocolSection")
    some = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    design = p["designModule"]
    return studies.select(
        p["identificationModule"]["nctId"].alias("nct_id"), p["identificationModule"]["briefTitle"].alias("brief_title"), p["identificationModule"]["officialTitle"].alias("official_title"),
        p["sponsorCollaboratorsModule"]["leadSponsor"]["name"].alias("lead_sponsor"), p["sponsorCollaboratorsModule"]["leadSponsor"]["class"].alias("lead_sponsor_class"),
        some(p["sponsorCollaboratorsModule"]["collaborators"]["name"]).alias("collaborators"), p["statusModule"]["overallStatus"].alias("overall_status"),
        p["statusModule"]["startDateStruct"]["date"].alias("start_date"), design["studyType"].alias("study_type"), some(design["phases"]).alias("phases"),
        design["designInfo"]["allocation"].alias("allocation"), design["designInfo"]["interventionModel"].alias("intervention_model"), design["designInfo"]["maskingInfo"]["masking"].alias("masking"),
        design["designInfo"]["primaryPurpose"].alias("primary_purpose"), design["enrollmentInfo"]["count"].alias("enrollment_count"), design["enrollmentInfo"]["type"].alias("enrollment_type"),
        some(p["conditionsModule"]["conditions"]).alias("conditions"), some(p["conditionsModule"]["keywords"]).alias("keywords"), p["eligibilityModule"]["eligibilityCriteria"].alias("eligibility_criteria"),
        p["eligibilityModule"]["sex"].alias("sex"), p["eligibilityModule"]["minimumAge"].alias("min_age"), p["eligibilityModule"]["maximumAge"].alias("max_age"),
        p["eligibilityModule"]["healthyVolunteers"].alias("healthy_volunteers"), p["armsInterventionsModule"]["armGroups"].alias("arms"),
        p["armsInterventionsModule"]["interventions"].alias("interventions"), p["outcomesModule"]["primaryOutcomes"].alias("primary_outcomes"), p["outcomesModule"]["secondaryOutcomes"].alias("secondary_outcomes"),
        F.try_element_at(F.filter(F.col("documentSection.largeDocumentModule.largeDocs"), lambda d: d["hasProtocol"]), F.lit(1)).alias("protocol_document"),
    )


def age(text: Column) -> Column:
    """Struct (value, unit) of an age text such as '18 Years'."""
    pattern = r"^\s*(\d+(?:\.\d+)?)\s*([A-Za-z]+)"
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found != "", F.struct(found.cast("double").alias("value"), F.lower(F.regexp_extract(text, pattern, 2)).alias("unit")))


def read_json(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """JSON documents (one per file) or JSON lines with a stated schema: nothing is inferred, so no file is read twice."""
    return spark.read.schema(schema).option("multiLine", not lines).option("mode", "PERMISSIVE").json(path)


def write_json_lines(frame: DataFrame, path: str, *partitions: str) -> None:
    frame.write.mode("overwrite").partitionBy(*partitions).json(path)


def write_markdown(report: DataFrame, path: str, columns: list[str], order: str) -> None:
    """A report as Markdown rows, sorted by range over the files so that no task holds them all."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), F.lit(" |"))
    report.orderBy(order).select(line.alias("value")).write.mode("overwrite").text(path)


def latest_results(new: DataFrame, old: DataFrame, key: str) -> DataFrame:
    """Rows of both layouts; where both have a key, those of `new`."""
    return new.unionByName(old.join(new.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def first_success(attempts: DataFrame) -> DataFrame:
    """doc_id, page_num, route, status: the first route of each page that succeeded; 'ok' for the primary one, 'fallback'
    for another, 'skipped' if a remote route was needed but absent, else 'error'."""
    ranked = attempts.groupBy("doc_id", "page_num").agg(
        F.min(F.when(F.col("outcome") == "ok", F.struct("route_rank", "route"))).alias("won"), F.max((F.col("outcome") == "remote_unavailable").cast("int")).alias("absent")
    )
    status = F.when(F.col("won.route_rank") == 0, "ok").when(F.col("won").isNotNull(), "fallback").when(F.col("absent") == 1, "skipped").otherwise("error")
    return ranked.select("doc_id", "page_num", F.col("won.route").alias("route"), status.alias("status"))


class Transient(Exception):
    """A failure worth another try: the network, a status of 5xx or 429."""


def with_retry(call: Callable, attempts: int = 3, first: float = 1.0, most: float = 8.0, sleep: Callable = time.sleep):
    """The call's result; transient failures are retried after waits that double up to `most` seconds."""
    for i in range(attempts):
        try:
            return call()
        except Transient:
            if i + 1 == attempts:
                raise
            sleep(min(most, first * 2**i))


def enrich_remotely(rows: DataFrame, client: Callable[[], Callable[[list[dict]], list[dict]]], schema: str, batch: int = 32) -> DataFrame:
    """Rows through a remote model in batches: `client` is called once per task and returns the function of a batch.

    A batch that keeps failing gives rows with their key columns and nulls, so that no row is lost.
    """
    names = [f.split()[0] for f in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = client()
        for frame in frames:
            records, out = frame.to_dict("records"), []
            for i in range(0, len(records), batch):
                some = records[i : i + batch]
                try:
                    out += with_retry(lambda some=some: ask(some))
                except Transient:
                    out += [{k: r.get(k) for k in names} for r in some]
            yield pd.DataFrame([{k: o.get(k) for k in names} for o in out], columns=names)

    return rows.mapInPandas(run, schema)


def layout_tree_blocks(trees: DataFrame) -> DataFrame:
    """doc_id, page_num, order_index, block_type, text, parent_index, x0..y1 of nested layout trees given as JSON.

    A pre-order walk needs running state, so it runs in Python per record: discarded items first, then the blocks; a
    list without own text passes its children the last block before it as parent. Unreadable trees give no rows.
    """
    schema = "doc_id string, page_num int, order_index int, block_type string, text string, parent_index int, x0 double, y0 double, x1 double, y1 double"

    def words(item: dict) -> str:
        lines = item.get("lines") or []
        return "\n".join("".join(s.get("content") or "" for s in (line.get("spans") or [])) for line in lines).strip()

    def walk(doc: str, page: int, items: list, parent: int | None, out: list) -> None:
        for item in items:
            text, kids = words(item), item.get("blocks") or []
            box = [float(v) for v in (item.get("bbox") or [])][:4]
            me = parent
            if text or not kids:
                me = len(out)
                out.append((doc, page, me, item.get("type") or "other", text, parent, *(box + [None] * 4)[:4]))
            elif item.get("type") == "list" and out:
                me = len(out) - 1
            walk(doc, page, kids, me, out)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows: list[tuple] = []
            for doc, tree in zip(frame["doc_id"], frame["tree"]):
                try:
                    pages = json.loads(tree) if tree else []
                    for page in pages if isinstance(pages, list) else [pages]:
                        out: list[tuple] = []
                        walk(doc, int(page.get("page_idx") or 0), [*(page.get("discarded_blocks") or []), *(page.get("para_blocks") or [])], None, out)
                        rows += out
                except (ValueError, TypeError, AttributeError, RecursionError):
                    continue
            result = pd.DataFrame(rows, columns=[f.split()[0] for f in schema.split(", ")], dtype=object)
            for name in ("page_num", "order_index", "parent_index"):
                result[name] = result[name].astype("Int32")
            yield result

    return trees.select("doc_id", "tree").mapInPandas(run, schema)
