"""Report files of the passes: written by the executors, named and versioned by the driver."""

from __future__ import annotations

import uuid
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.paths import disk
from .functions.text import report_text
from .operators.closure import scope


def _system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _system(spark, path)
    return system.exists(at)


def versioned(spark: SparkSession, path: str) -> str:
    """The path, or where it is taken the first free one with _v1, _v2, ... before its extension."""
    if not exists(spark, path):
        return path
    folder, _, name = path.rpartition("/")
    base, dot, ext = name.rpartition(".") if name.lstrip(".").count(".") else (name, "", "")
    n = 1
    while exists(spark, made := f"{folder}/{base}_v{n}{dot}{ext}"):
        n += 1
    return made


def run_folder(spark: SparkSession, folder: str, keep: bool = False) -> str:
    """Folder for a run's reports: the next free tryN with ``keep``; else try1, after try1, try2, ... are deleted up to the first gap."""
    n = 1
    while exists(spark, f"{folder}/try{n}"):
        if not keep:
            system, at = _system(spark, f"{folder}/try{n}")
            system.delete(at, True)
        n += 1
    return f"{folder}/try{n if keep else 1}"


#: Setting of a session by which reports become folders of parts, see ``write_file``.
PARTS = "spark.buildlens.reports.parts"


def in_parts(spark: SparkSession) -> bool:
    return spark.conf.get(PARTS, "false").lower() == "true"


def write_file(lines: DataFrame, path: str, comma: str = "", parts: bool | None = None) -> None:
    """Text of the column ``line`` by ``place`` and ``ord``; with ``comma`` lines of place 1 after the first begin with it.

    With ``parts`` (None: the session's setting ``PARTS``) the path is a folder of files, each a range of the order that
    its own task sorts and writes; one after another by name they are the document. Else it is one file, which
    a single task writes, streaming the sorted lines. What lies at the path is replaced.
    """
    spark = lines.sparkSession
    parts = in_parts(spark) if parts is None else parts
    lines = lines.withColumn("ord", F.coalesce("ord", F.lit("")))
    # rows with the least order lie in one range, so its first row is the document's first
    first = lines.filter("place = 1").agg(F.min("ord")).first()[0] if comma else None

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = False
        for batch in batches:
            out = []
            for place, order, line in zip(*(batch.column(c).to_pylist() for c in ("place", "ord", "line")), strict=True):
                out.append(comma + line if place == 1 and (seen or order != first) else line)
                seen = seen or place == 1
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])

    rows = lines.select("place", "ord", "line").orderBy("place", "ord")
    rows = rows if parts else rows.coalesce(1)
    rows = rows.mapInArrow(joined, "value string") if comma else rows.select(F.col("line").alias("value"))
    folder = f"{path}.{uuid.uuid4().hex}"
    rows.write.text(folder)
    system, at = _system(spark, folder)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system.delete(target, True)
    if parts:
        system.rename(at, target)
        return
    for status in system.listStatus(at):
        if status.getPath().getName().startswith("part-"):
            system.rename(status.getPath(), target)
    system.delete(at, True)


def _lines(spark: SparkSession, place: int, *texts: str) -> DataFrame:
    return spark.createDataFrame([(place, str(k).zfill(4), t) for k, t in enumerate(texts)], "place int, ord string, line string")


def _stamp(spark: SparkSession) -> str:
    return spark.sql("SELECT date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss\")").first()[0]


def write_category_json(rows: DataFrame, path: str, category: str) -> int:
    """One JSON document {category, total, generated_at, files} with a line a file, by path; returns the total."""
    spark = rows.sparkSession
    total = rows.count()
    head = f'{{"category": "{category}", "total": {total}, "generated_at": "{_stamp(spark)}", "files": ['
    fields = F.struct(*(F.coalesce(c, F.lit("")).alias(c) if c in ("path", "hash") else F.col(c) for c in rows.columns if c != "category"))
    files = rows.select(F.lit(1).alias("place"), F.coalesce("path", F.lit("")).alias("ord"), F.to_json(fields).alias("line"))
    write_file(_lines(spark, 0, head).union(files).union(_lines(spark, 2, "]}")), path, ",")
    return total


def write_tsv(rows: DataFrame, path: str, category: str) -> str:
    """Distinct (path, hash) with a tab between and a header after #, by path; null counts as blank, rows with both blank are left out.

    Returns the file's name, which has _EMPTY before its extension where nothing is left.
    """
    spark = rows.sparkSession
    pairs = rows.select(*(F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in ("path", "hash"))).filter("path <> '' OR hash <> ''").distinct()
    total = pairs.count()
    if not total:
        base, dot, ext = path.rpartition(".")
        path = f"{base}_EMPTY{dot}{ext}"
    head = _lines(spark, 0, f"# {category}", f"# Generated: {_stamp(spark)}", f"# Total: {total}", *(("# Format: path<TAB>hash", "#") if total else ("# empty",)))
    write_file(head.union(pairs.select(F.lit(1).alias("place"), F.concat_ws("\t", "path", "hash").alias("ord"), F.concat_ws("\t", "path", "hash").alias("line"))), path)
    return path


def write_categories(rows: DataFrame, folder: str) -> None:
    """All classes of (path, hash, category, ...) rows at once, as JSON lines by category, of many projects also by project: for results that no single file should hold."""
    rows.write.mode("overwrite").partitionBy(*scope(rows), "category").json(folder)


def write_by_disk(rows: DataFrame, folder: str) -> None:
    """Pass 5: JSON lines by category and disk."""
    rows.withColumn("disk", disk(F.col("path"))).write.mode("overwrite").partitionBy(*scope(rows), "category", "disk").json(folder)


def write_packages(packages: DataFrame, path: str) -> str:
    """Packages with their files as one JSON document, by type and name, under the first free versioned name, which is returned."""
    spark = packages.sparkSession
    path = versioned(spark, path)
    sums = packages.agg(F.coalesce(F.sum("files_count"), F.lit(0)).alias("files"), F.count("*").alias("packages")).first()
    head = f'{{"category": "external_package_content", "generated": "{_stamp(spark)}", "total_files": {sums.files}, "total_packages": {sums.packages}, "packages": ['
    order = F.concat_ws("\x00", "package_type", "container")
    write_file(_lines(spark, 0, head).union(packages.select(F.lit(1).alias("place"), order.alias("ord"), F.to_json(F.struct(*packages.columns)).alias("line"))).union(_lines(spark, 2, "]}")), path, ",")
    return path


def write_package_tsv(content: DataFrame, path: str) -> str:
    """Every row of package content as path, tab, hash, by path, with totals in the header; the versioned name is returned."""
    spark = content.sparkSession
    path = versioned(spark, path)
    n = content.agg(F.count("*").alias("files"), F.count_distinct(F.coalesce("package_type", F.lit("")), F.coalesce("container", F.lit(""))).alias("packages")).first()
    head = _lines(spark, 0, "# external_package_content", f"# Generated: {_stamp(spark)}", f"# Total files: {n.files}, Total packages: {n.packages}", "# Format: path<TAB>hash", "#")
    line = F.concat(F.coalesce("path", F.lit("")), F.lit("\t"), F.coalesce("hash", F.lit("")))
    write_file(head.union(content.select(F.lit(1).alias("place"), F.coalesce("path", F.lit("")).alias("ord"), line.alias("line"))), path)
    return path


def summary_lines(project: str, shares: list, totals, elapsed: str = "00:00:00") -> list[str]:
    """Text of a summary from the rows of ``summaries.shares`` and ``summaries.totals``."""
    bar = "=" * 54
    out = [bar, f"  Summary: {project}", f"  Elapsed: {elapsed}", bar]
    sections = (("source", "Compiled sources", totals.total_source), ("interpreted", "Interpreted files", totals.total_interpreted), ("binaries", "Origin of binaries", totals.total_binaries))
    for section, title, total in sections:
        own = sorted((r for r in shares if r.section == section), key=lambda r: (-r.files, r.category))
        if section != "binaries" or total:
            out += ["", f"  {title} ({total} files)", "  " + "-" * 50, *(f"  {r.category:<32}: {r.files:>7}  ({r.percent:.1f}%)" for r in own)]
    part = lambda n: 100.0 * n / totals.total_all if totals.total_all else 0.0
    out += ["", f"  All ({totals.total_all} files)", "  " + "-" * 50, f"  {'used':<32}: {totals.used_all:>7}  ({part(totals.used_all):.1f}%)", f"  {'redundant':<32}: {totals.redundant_all:>7}  ({part(totals.redundant_all):.1f}%)", bar]
    return out


def write_summary(spark: SparkSession, path: str, lines: list[str]) -> None:
    write_file(_lines(spark, 0, *lines), path, parts=False)


def copy_reports(spark: SparkSession, reports: dict[str, tuple[str, str]], folder: str) -> list[str]:
    """Copies reports (name to file and description) that aren't empty to ``folder`` and writes a README that lists them; returns the listed names.

    Reports in parts stay where they are and are only listed, with their places.
    """
    util, conf = spark._jvm.org.apache.hadoop.fs.FileUtil, spark._jsc.hadoopConfiguration()
    copied = []
    for name, (path, _) in sorted(reports.items()):
        if not path.rpartition(".")[0].endswith("_EMPTY") and exists(spark, path):
            (source, at), (target, to) = _system(spark, path), _system(spark, f"{folder}/{name}")
            if source.getFileStatus(at).isFile():
                util.copy(source, at, target, to, False, True, conf)
            copied.append(name)
    place = (lambda n: f" ({reports[n][0]})") if in_parts(spark) else (lambda n: "")
    write_summary(spark, f"{folder}/README.md", ["# Reports", "", *(f"- `{n}`: {reports[n][1]}{place(n)}" for n in copied)])
    return copied


def write_extensions(counts: DataFrame, path: str, project: str, side: str, where: str) -> None:
    """Profile of extensions (ext, files): a JSON document and, beside it with the ending .txt, a table by number."""
    spark = counts.sparkSession
    rows = counts.orderBy(F.desc("files"), "ext").collect()  # a row an extension
    total = sum(r.files for r in rows)
    from json import dumps

    document = {"project": project, "subdir": side, "path": where, "analyzed_at": _stamp(spark), "total_files": total, "extensions": {r.ext: r.files for r in rows}}
    write_summary(spark, path, dumps(document, ensure_ascii=False, indent=4).split("\n"))
    write_summary(spark, path.rpartition(".")[0] + ".txt", [f"# {project}/{side}", f"# Total files: {total}", *(f"{r.files:>10}  {r.ext}" for r in rows)])


def write_binaries(found: DataFrame, path: str) -> None:
    """List of binaries (type, path) in columns, those told by extension first."""
    spark = found.sparkSession
    column = lambda c: F.rpad(c, 12, " ")
    rows = found.select(F.when(F.col("type") == "BINARY_EXT", 1).otherwise(2).alias("place"), F.col("path").alias("ord"), F.concat(column("type"), F.lit("  "), "path").alias("line"))
    write_file(_lines(spark, 0, f"{'TYPE':<12}  PATH", f"{'-' * 12}  ----").union(rows), path)


def write_signatures(signatures: DataFrame, path: str, directory: str) -> None:
    """Signatures of files as one JSON document {directory, signatures}, by path."""
    spark = signatures.sparkSession
    line = F.to_json(F.struct("path", "hash", "archive", "parents_hash", "parents_chain"))
    rows = signatures.filter("hash <> ''").select(F.lit(1).alias("place"), F.col("path").alias("ord"), line.alias("line"))
    from json import dumps

    write_file(_lines(spark, 0, f'{{"directory": {dumps(directory)}, "signatures": [').union(rows).union(_lines(spark, 2, "]}")), path, ",")


def _cell(column: int, row: int, text: str, style: int) -> str:
    return f'<c r="{chr(65 + column)}{row}" t="inlineStr" s="{style}"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def write_xlsx(rows: DataFrame, path: str, widths: dict[str, int] | None = None) -> None:
    """A spreadsheet on the driver's disk, for reports that people read: bold header that stays in view, filters, widths. At most 26 columns; rows come one partition at a time."""
    names = rows.columns
    shown: list[Column] = [report_text(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in names]
    last = chr(64 + len(names))
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    parts = {
        "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/></Types>',
        "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets><sheet name="Report" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="2"><xf/><xf fontId="1" applyFont="1"/></cellXfs></styleSheet>',
    }
    columns = "".join(f'<col min="{k + 1}" max="{k + 1}" width="{(widths or {}).get(c, 20)}" customWidth="1"/>' for k, c in enumerate(names))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
        with z.open("xl/worksheets/sheet1.xml", "w") as sheet:
            put = lambda text: sheet.write(text.encode())
            put(f'<worksheet xmlns="{main}"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><cols>{columns}</cols><sheetData>')
            put('<row r="1">' + "".join(_cell(k, 1, c, 1) for k, c in enumerate(names)) + "</row>")
            n = 1
            for n, row in enumerate(rows.select(*shown).toLocalIterator(), 2):
                put(f'<row r="{n}">' + "".join(_cell(k, n, text, 0) for k, text in enumerate(row)) + "</row>")
            put(f'</sheetData><autoFilter ref="A1:{last}{n}"/></worksheet>')
