"""Where documents come from: source dispatch, identifiers, metadata folders, media candidates and the keep-or-replace rule.
Bytes are landed by others; nothing here opens a connection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..schemas import PAPER

# Public addresses and image signatures (hex).
EFETCH = "https://eutils.ncbi.nlm.nih.gov/entrez/eutils/efetch.fcgi"
ARXIV_HTML = "https://export.arxiv.org/html/"
PMC_ARTICLE = "https://pmc.ncbi.nlm.nih.gov/articles/"
PMCID = r"^PMC(\d+)$"
ARXIV = r"^(\d{4}\.\d{4,5})(v\d+)?$"
LINKS = r"""(?i)(?:src|href)=["']([^"']+)["']"""
RASTER = (".jpg", ".jpeg", ".png", ".gif")
MAGIC = ("FFD8FF", "89504E470D0A1A0A", "474946383761", "474946383961")


def checked(value: Column, pattern: str, told: str) -> Column:
    """value if it fits, null if null; otherwise the job fails."""
    return F.when(value.isNull() | value.rlike(pattern), value).otherwise(F.raise_error(F.concat(F.lit(f"bad {told} "), value)))


def pmc_url(pmcid: Column) -> Column:
    return F.concat(F.lit(EFETCH + "?db=pmc&id="), F.regexp_extract(checked(pmcid, PMCID, "PMCID"), PMCID, 1))


def arxiv_url(arxiv: Column) -> Column:
    ok = checked(arxiv, ARXIV, "arxiv id")
    return F.concat(F.lit(ARXIV_HTML), F.regexp_extract(ok, ARXIV, 1), F.regexp_extract(ok, ARXIV, 2))


def given(column: Column) -> Column:
    return column.isNotNull() & (column != "")


def dispatched(papers: DataFrame) -> DataFrame:
    """papers (pmcid, arxiv, pdf) with source_kind and source_url: the first of the three that is given. A paper with none, or a
    pdf without https, has kind null and says why in source_error."""
    pmc, arx, pdf = (given(F.col(c)) for c in ("pmcid", "arxiv", "pdf"))
    secure = F.startswith("pdf", F.lit("https://"))
    kind = F.when(pmc, "pmcid").when(arx, "arxiv").when(pdf & secure, "pdf")
    url = F.when(pmc, pmc_url(F.col("pmcid"))).when(arx, arxiv_url(F.col("arxiv"))).when(pdf & secure, F.col("pdf"))
    error = F.when(kind.isNotNull(), None).when(pdf, "pdf must be an https URL").otherwise("no pmcid, arxiv, or pdf")
    return papers.withColumns({"source_kind": kind, "source_url": url, "source_error": error})


def read_papers(spark: SparkSession, path: str, files: str = "*") -> DataFrame:
    """Paper metadata, a JSON object each (schema fixed, corrupt files fail). files: the names of the files to read."""
    return spark.read.schema(PAPER).option("pathGlobFilter", files).option("mode", "FAILFAST").option("multiLine", "true").json(path)


def scan_papers(spark: SparkSession, root: str) -> DataFrame:
    """Papers of a folder with one folder a paper, named by its slug: metadata in meta.json, the body in index.md (null without)."""
    slug = F.element_at(F.split("_metadata.file_path", "/"), -2).alias("slug")
    meta = read_papers(spark, f"{root}/*", "meta.json")
    meta = meta.select(slug, *[c for c in PAPER.names if c not in ("slug", "body")])
    bodies = spark.read.option("pathGlobFilter", "index.md").text(f"{root}/*", wholetext=True).select(slug, F.col("value").alias("body"))
    return meta.join(bodies, "slug", "left").select(*PAPER.names)


def published(papers: DataFrame) -> DataFrame:
    """Papers of any status but not-started that have a body, newest first; a malformed slug fails the job."""
    rows = papers.where((F.coalesce("status", F.lit("not-started")) != "not-started") & F.col("body").isNotNull())
    return rows.withColumn("slug", checked(F.col("slug"), X.SLUG, "slug")).orderBy(F.desc(F.coalesce("year", F.lit(0))), "slug")


def file_name(href: Column) -> Column:
    return F.substring_index(F.substring_index(href, "/", -1), "?", 1)


def image_stem(name: Column) -> Column:
    """A file's name without folder, query, an _HTML mark and an image ending."""
    return F.regexp_replace(F.regexp_replace(file_name(name), r"(?i)_HTML(?=\.(?:jpe?g|png|gif)\b)", ""), r"(?i)\.(?:jpeg|jpg|png|gif)$", "")


def absolute(base: Column, href: Column) -> Column:
    """href against an https base that ends in a slash."""
    host = F.regexp_extract(base, r"^https://[^/]+", 0)
    return F.when(href.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), href).when(F.startswith(href, F.lit("//")), F.concat(F.lit("https:"), href)).when(F.startswith(href, F.lit("/")), F.concat(host, href)).otherwise(F.concat(base, href))


def candidate_graphics(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc_id, filename, pos, url: raster links of a page (doc_id, pmcid, html) that belong to a wanted file (doc_id, filename),
    by name or by stem; https only, each url once, in page order."""
    base = F.concat(F.lit(PMC_ARTICLE), checked(F.col("pmcid"), PMCID, "PMCID"), F.lit("/"))
    links = pages.select("doc_id", base.alias("base"), F.posexplode(X.matches(F.col("html"), LINKS, 1)).alias("pos", "href"))
    name = F.lower(file_name(F.col("href")))
    links = links.where(F.array_contains(F.array(*map(F.lit, RASTER)), F.regexp_extract(name, r"\.[^.]*$", 0)))
    links = links.select("doc_id", "pos", absolute(F.col("base"), F.col("href")).alias("url"), file_name(F.col("href")).alias("name"), F.lower(image_stem(F.col("href"))).alias("stem")).where(F.startswith("url", F.lit("https://")))
    keyed = wanted.select("doc_id", "filename", F.lower(image_stem(F.col("filename"))).alias("stem"))
    named = wanted.select("doc_id", "filename", file_name(F.col("filename")).alias("name"))
    hits = links.join(keyed, ["doc_id", "stem"]).select("doc_id", "filename", "pos", "url").unionByName(links.join(named, ["doc_id", "name"]).select("doc_id", "filename", "pos", "url"))
    return hits.groupBy("doc_id", "filename", "url").agg(F.min("pos").alias("pos")).select("doc_id", "filename", "pos", "url")


def is_image(content: Column) -> Column:
    """Whether bytes are a JPEG, PNG or GIF by signature, or SVG and not HTML within their first 800."""
    start = F.hex(F.substring(content, 1, 8))
    known = start.rlike("^(?:" + "|".join(MAGIC) + ")")
    head = F.lower(F.regexp_replace(F.decode(F.substring(content, 1, 4096), "ISO-8859-1"), r"^\s+", "").substr(1, 800))
    return F.coalesce(known | (F.contains(head, F.lit("<svg")) & ~F.contains(head, F.lit("<html"))), F.lit(False))


def largest(candidates: DataFrame, key: list[str], size: str = "size", order: str = "pos") -> DataFrame:
    """The largest candidate of each key; of equals the first in order."""
    w = Window.partitionBy(*key).orderBy(F.desc(size), order)
    return candidates.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merge_assets(local: DataFrame, remote: DataFrame, key: list[str]) -> DataFrame:
    """key, keep_local, url: a local file (size, image) stays if it is an image and no smaller than the best remote one (url, size),
    or if there is no remote one; url is null where there is nothing to fetch."""
    a = local.select(*key, F.col("size").alias("local_size"), F.col("image").alias("local_image"))
    b = remote.select(*key, "url", F.col("size").alias("remote_size"))
    keep = F.coalesce("local_image", F.lit(False)) & (F.col("remote_size").isNull() | (F.col("local_size") >= F.col("remote_size")))
    return a.join(b, key, "full").withColumn("keep_local", keep).select(*key, "keep_local", F.when(~F.col("keep_local"), F.col("url")).alias("url"))


def first_seen(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """Distinct keys with their first place in the order."""
    return rows.groupBy(*key).agg(F.min(order).alias(order))
