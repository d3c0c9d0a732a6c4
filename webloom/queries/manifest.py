"""Queries of the manifest side: index scan, selection, dedup, slices, chunks, status tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from webloom.operators import manifest as m
from webloom.operators import queue as q
from webloom.sources import index
from webloom.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
NOW = "2026-01-01 00:00:00"
CHUNK, RANKS = 100, 7


def _selected(s: SparkSession, d: str) -> DataFrame:
    return m.select_records(table(s, d, "crawl_index"))


def _deduped(s: SparkSession, d: str) -> DataFrame:
    return m.keep_first(_selected(s, d))


def _numbered(s: SparkSession, d: str) -> DataFrame:
    return m.with_row_index(_deduped(s, d))


def _now() -> F.Column:
    return F.to_timestamp(F.lit(NOW))


COLS = ", ".join(m.COLUMNS)
SEL = f"select {COLS} from crawl_index where fetch_status = 200 and content_mime_detected in ('text/html', 'application/xhtml+xml') and list_contains(string_split(content_languages, ','), 'ell')"
DEDUP = f"select {COLS} from (select *, row_number() over (partition by content_digest order by warc_filename, warc_record_offset, url nulls first, url_host_registered_domain nulls first, content_languages nulls first, warc_record_length nulls first) as k from ({SEL})) where k = 1"
NUMBERED = f"select row_number() over (order by warc_filename, warc_record_offset, url nulls first, url_host_registered_domain nulls first, content_digest nulls first, content_languages nulls first, warc_record_length nulls first) - 1 as row_idx, {COLS} from ({DEDUP})"


def lang_match(s: SparkSession, d: str) -> DataFrame:
    c = F.col("content_languages")
    return table(s, d, "crawl_index").groupBy(c).agg(F.count(F.lit(1)).alias("n_rows")).select(c, F.coalesce(m.has_language(c, "ell"), F.lit(False)).alias("exact"), F.coalesce(c.contains("ell"), F.lit(False)).alias("substring"), "n_rows")


def two_level(s: SparkSession, d: str) -> DataFrame:
    idx = table(s, d, "crawl_index")
    slices = [m.keep_first(m.select_records(idx.where(F.pmod("part_index", F.lit(3)) == k))) for k in range(3)]
    return m.keep_first(m.union(slices, s))


def by_crawl(s: SparkSession, d: str) -> DataFrame:
    crawls = [r[0] for r in table(s, d, "crawl_status").select("crawl_id").orderBy("crawl_id").collect()]
    idx = table(s, d, "crawl_index")
    return m.union([m.select_records(idx.where(F.col("crawl") == c)) for c in crawls], s)


def part_counts(s: SparkSession, d: str) -> DataFrame:
    return m.wanted(table(s, d, "crawl_index")).groupBy("crawl", "part_index").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("content_digest").alias("n_digests"))


def row_counts(s: SparkSession, d: str) -> DataFrame:
    """Counted rows beside those the status table states, for successful parts."""
    got = m.wanted(table(s, d, "crawl_index")).select("crawl", "part_index", *[c for c in m.COLUMNS]).distinct().groupBy("crawl", "part_index").agg(F.count(F.lit(1)).alias("counted"))
    parts = table(s, d, "part_status").where("status = 'success'").select(F.col("crawl_id").alias("crawl"), "part_index", F.col("row_count").alias("stated"))
    return parts.join(got, ["crawl", "part_index"], "left").select("crawl", "part_index", "stated", F.coalesce("counted", F.lit(0)).alias("counted"))


def total(s: SparkSession, d: str) -> DataFrame:
    return _deduped(s, d).agg(F.count(F.lit(1)).alias("n_rows"))


def resume(s: SparkSession, d: str) -> DataFrame:
    """Where extraction goes on, from the names of published chunks: all but the last two of the crawl's chunks."""
    names = m.chunk_bounds(total(s, d), CHUNK)
    last = names.agg(F.max("start_row").alias("last"))
    have = names.join(F.broadcast(last), F.col("start_row") <= F.col("last") - 2 * CHUNK, "left_semi")
    return m.resume_point(index.published_chunks(have))


def paths(s: SparkSession, d: str) -> DataFrame:
    lines = table(s, d, "part_status").select(F.regexp_replace("part_url", "^s3://crawl-store/", "").alias("value"))
    return index.part_paths(lines.union(lines.select(F.regexp_replace("value", "subset=warc", "subset=robotstxt"))), "CC-MAIN-2013-22", "s3://crawl-store/")


def files(s: SparkSession, d: str) -> DataFrame:
    f = table(s, d, "part_status").select(F.concat(F.lpad(F.col("id").cast("string"), 5, "0"), F.lit("_"), F.lpad(F.col("part_index").cast("string"), 5, "0"), F.lit(".parquet")).alias("name"), F.coalesce("row_count", F.lit(0)).alias("size"))
    return f.select("name", "size", index.file_kind(F.col("name"), F.col("size"), 2).alias("kind"))


def parts(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "part_status")


def crawls(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "crawl_status")


def _rank(s: SparkSession, d: str) -> DataFrame:
    numbered = _numbered(s, d)
    return m.rank_of(numbered, RANKS, numbered.count()).select("row_idx", "rank")


def _new_parts(s: SparkSession, d: str) -> DataFrame:
    return parts(s, d).select(F.concat(F.col("crawl_id"), F.when(F.col("part_index") == 0, "").otherwise("-x")).alias("crawl_id"), "part_url", "part_index").distinct()


def _new_crawls(s: SparkSession, d: str) -> DataFrame:
    return parts(s, d).groupBy(F.concat(F.substring("crawl_id", 1, 12), F.lit("-22")).alias("crawl_id")).agg(F.count(F.lit(1)).cast("int").alias("total_parts"))


def _gated(s: SparkSession, d: str) -> DataFrame:
    """The gate with every crawl of the table taken as under way and every open part as failed."""
    own = crawls(s, d).withColumn("status", F.lit("fetching"))
    closed = parts(s, d).withColumn("status", F.when(F.col("status").isin("pending", "running"), "failed").otherwise(F.col("status")))
    return q.merge_gate(own, closed, 0.9).withColumn("ratio", F.round("ratio", 6))


def _ensured(s: SparkSession, d: str) -> DataFrame:
    """Name and type of the status tables' columns, and that each table of the data fits them."""
    out = []
    for name, empty, have in zip(("crawl_status", "part_status"), q.empty_tables(s), (crawls(s, d), parts(s, d)), strict=True):
        got = {f.name: f.dataType for f in have.schema.fields}
        out += [(name, f.name, f.dataType.simpleString(), got.get(f.name) == f.dataType, empty.count()) for f in empty.schema.fields]
    return s.createDataFrame(out, "table_name string, column_name string, column_type string, fits boolean, n_rows bigint")


QUERIES: dict[str, Query] = {
    "index_filter_project": _selected,
    "index_lang_exact_match": lang_match,
    "manifest_dedup_keep_first": _deduped,
    "manifest_dedup_two_level": two_level,
    "manifest_union_fragments": by_crawl,
    "manifest_part_counts": part_counts,
    "manifest_counts_against_status": row_counts,
    "manifest_row_index": _numbered,
    "manifest_slice": lambda s, d: m.slice_rows(_numbered(s, d), 100, 250),
    "rank_split": _rank,
    "chunk_bounds": lambda s, d: m.chunk_bounds(total(s, d), CHUNK),
    "resume_prefix": resume,
    "published_chunk_offsets": lambda s, d: index.published_chunks(m.chunk_bounds(total(s, d), CHUNK)),
    "path_list_filter": paths,
    "stale_file_classify": files,
    "queue_status_counts": lambda s, d: q.status_counts(parts(s, d)),
    "queue_ready_to_merge": lambda s, d: q.ready_crawls(crawls(s, d), parts(s, d)).select("crawl_id", "status"),
    "queue_oldest_ready": lambda s, d: q.ready_crawls(crawls(s, d), parts(s, d)).select("crawl_id").orderBy("crawl_id").limit(1),
    "queue_claim_next": lambda s, d: q.next_parts(parts(s, d), 5).select("id", "crawl_id", "part_url", "part_index"),
    "queue_claim": lambda s, d: q.claim(parts(s, d), 5, _now()).select("id", "status", "attempt_count", "updated_at"),
    "queue_fragments": lambda s, d: q.fragments(parts(s, d)),
    "queue_mark_success": lambda s, d: q.mark_success(parts(s, d), F.col("status") == "running", F.concat(F.lit("done/"), F.col("id").cast("string")), F.lit(7).cast("bigint"), _now()).select("id", "status", "fragment_path", "row_count", "last_error"),
    "queue_mark_error": lambda s, d: q.mark_error(parts(s, d), F.col("status") == "running", F.repeat(F.lit("x"), 3000)).select("id", "status", "attempt_count", F.length("last_error").alias("error_length")),
    "queue_requeue": lambda s, d: q.requeue_failed(parts(s, d), F.lit(True)).select("id", "status", "attempt_count"),
    "queue_release_stale": lambda s, d: q.release_stale(parts(s, d), _now()).select("id", "status"),
    "queue_success_ratio": lambda s, d: q.success_ratio(parts(s, d)).withColumn("ratio", F.round("ratio", 6)),
    "queue_merge_gate": _gated,
    "queue_ensure_schema": _ensured,
    "queue_register_parts": lambda s, d: q.register(parts(s, d), _new_parts(s, d), _now()),
    "queue_upsert_crawl": lambda s, d: q.upsert_crawl(crawls(s, d), _new_crawls(s, d), _now()),
    "queue_remaining_crawls": lambda s, d: q.remaining(table(s, d, "crawl_index").select(F.col("crawl").alias("crawl_id")).distinct(), crawls(s, d).where("status = 'done'")),
    "queue_seeded_crawls": lambda s, d: crawls(s, d).select("crawl_id").distinct(),
    "queue_orphan_parts": lambda s, d: q.orphans(parts(s, d), crawls(s, d).where("status = 'done'")).select("id", "crawl_id"),
    "queue_mark_merging": lambda s, d: q.mark_merging(crawls(s, d), F.col("status") == "fetching", _now()),
    "queue_mark_done": lambda s, d: q.mark_done(crawls(s, d), F.col("status") != "done", parts(s, d), F.concat(F.lit("out/"), "crawl_id"), F.lit(5), 0.5, _now()),
    "exact_dedup_removed": lambda s, d: _selected(s, d).join(_deduped(s, d).select("warc_filename", "warc_record_offset"), ["warc_filename", "warc_record_offset"], "left_anti").select(*m.COLUMNS),
}

TOTAL = f"select count(*) as n from ({DEDUP})"
SQL: dict[str, str] = {
    "index_filter_project": SEL,
    "index_lang_exact_match": "select content_languages, coalesce(list_contains(string_split(content_languages, ','), 'ell'), false) as exact, coalesce(contains(content_languages, 'ell'), false) as substring, count(*) as n_rows from crawl_index group by all",
    "manifest_dedup_keep_first": DEDUP,
    "manifest_dedup_two_level": DEDUP,
    "manifest_union_fragments": SEL,
    "manifest_part_counts": f"select crawl, part_index, count(*) as n_rows, count(distinct content_digest) as n_digests from ({SEL.replace('select ', 'select crawl, part_index, ', 1)}) group by all",
    "manifest_counts_against_status": f"with g as (select crawl, part_index, count(*) as counted from (select distinct crawl, part_index, {COLS} from ({SEL.replace('select ', 'select crawl, part_index, ', 1)})) group by all) select p.crawl_id as crawl, p.part_index, p.row_count as stated, coalesce(counted, 0) as counted from part_status p left join g on p.crawl_id = g.crawl and p.part_index = g.part_index where p.status = 'success'",
    "manifest_row_index": NUMBERED,
    "manifest_slice": f"select * from ({NUMBERED}) where row_idx >= 100 and row_idx < 350",
    "rank_split": f"select row_idx, (ntile({RANKS}) over (order by row_idx) - 1)::int as rank from ({NUMBERED})",
    "chunk_bounds": f"select s as start_row, least({CHUNK}, n - s) as length, 'chunk_' || lpad(s::varchar, 12, '0') as name from (select n, unnest(range(0, n, {CHUNK})) as s from ({TOTAL}))",
    "resume_prefix": f"select k as n_chunks, case when k <> 1 then k::bigint * {CHUNK} end as next_row, case when k = 1 then 'one chunk alone does not tell the distance' end as error from (select greatest(ceil(n / {CHUNK})::int - 2, 0)::int as k from ({TOTAL}))",
    "published_chunk_offsets": f"select s as start_row from (select unnest(range(0, n, {CHUNK})) as s from ({TOTAL}))",
    "path_list_filter": "select (row_number() over (order by part_url) - 1)::int as part_index, part_url from part_status where contains(part_url, 'crawl=CC-MAIN-2013-22/subset=warc/')",
    "stale_file_classify": "select lpad(id::varchar, 5, '0') || '_' || lpad(part_index::varchar, 5, '0') || '.parquet' as name, coalesce(row_count, 0) as size, case when coalesce(row_count, 0) = 0 then 'empty' when part_index >= 2 then 'stale' else 'keep' end as kind from part_status",
    "queue_status_counts": "select crawl_id, status, count(*) as n_parts from part_status group by all",
    "queue_success_ratio": "select crawl_id, count(*) as total, sum(case when status = 'success' then 1 else 0 end)::bigint as success, round(sum(case when status = 'success' then 1 else 0 end) / count(*), 6) as ratio from part_status group by crawl_id",
    "queue_ready_to_merge": "select crawl_id, status from crawl_status c where status in ('fetching', 'merging') and not exists (select 1 from part_status p where p.crawl_id = c.crawl_id and p.status in ('pending', 'running'))",
    "queue_oldest_ready": "select min(crawl_id) as crawl_id from crawl_status c where status in ('fetching', 'merging') and not exists (select 1 from part_status p where p.crawl_id = c.crawl_id and p.status in ('pending', 'running')) having count(*) > 0",
    "queue_claim_next": "select id, crawl_id, part_url, part_index from part_status where status = 'pending' order by crawl_id, part_index, id limit 5",
    "queue_claim": f"with c as (select id from part_status where status = 'pending' order by crawl_id, part_index, id limit 5) select id, case when id in (from c) then 'running' else status end as status, case when id in (from c) then attempt_count + 1 else attempt_count end as attempt_count, case when id in (from c) then timestamptz '{NOW}+00' else updated_at end as updated_at from part_status",
    "queue_fragments": "select crawl_id, part_index, fragment_path, row_count from part_status where status = 'success' and fragment_path is not null",
    "queue_mark_success": "select id, case when status = 'running' then 'success' else status end as status, case when status = 'running' then 'done/' || id else fragment_path end as fragment_path, case when status = 'running' then 7 else row_count end as row_count, case when status = 'running' then null else last_error end as last_error from part_status",
    "queue_mark_error": "select id, case when status = 'running' then case when attempt_count >= 5 then 'failed' else 'pending' end else status end as status, attempt_count, case when status = 'running' then 2000 else length(last_error) end::int as error_length from part_status",
    "queue_requeue": "select id, case when status = 'failed' then 'pending' else status end as status, case when status = 'failed' then 0 else attempt_count end as attempt_count from part_status",
    "queue_release_stale": f"select id, case when status = 'running' and started_at < timestamptz '{NOW}+00' then 'pending' else status end as status from part_status",
    "queue_register_parts": f"select id, crawl_id, part_url, part_index, status, fragment_path, row_count, attempt_count, last_error, started_at, finished_at, created_at, updated_at from part_status union all select (select max(id) from part_status) + row_number() over (order by crawl_id, part_index, part_url), crawl_id, part_url, part_index, 'pending', null, null, 0, null, null, null, timestamptz '{NOW}+00', timestamptz '{NOW}+00' from (select crawl_id || '-x' as crawl_id, part_url, min(part_index) as part_index from part_status where part_index <> 0 group by 1, 2)",
    "queue_upsert_crawl": f"with n as (select substring(crawl_id, 1, 12) || '-22' as crawl_id, count(*)::int as k from part_status group by 1) select coalesce(c.crawl_id, n.crawl_id) as crawl_id, case when k is null then c.status else 'fetching' end as status, coalesce(k, c.total_parts) as total_parts, c.success_parts, c.failed_parts, c.min_success_ratio_used, c.output_path, c.row_count, c.last_error, case when k is null then c.started_at else coalesce(c.started_at, timestamptz '{NOW}+00') end as started_at, c.finished_at, case when c.crawl_id is null then timestamptz '{NOW}+00' else c.created_at end as created_at, case when k is null then c.updated_at else timestamptz '{NOW}+00' end as updated_at from crawl_status c full join n on c.crawl_id = n.crawl_id",
    "queue_merge_gate": "select crawl_id, coalesce(t, 0) as total, coalesce(g, 0) as success, round(coalesce(g / t, 0)::double, 6) as ratio, case when coalesce(g / t, 0) < 0.9 then 'requeue' else 'merge' end as action from crawl_status left join (select crawl_id, count(*) as t, count(*) filter (status = 'success') as g from part_status group by 1) using (crawl_id)",
    "queue_ensure_schema": "select table_name, column_name, case data_type when 'VARCHAR' then 'string' when 'INTEGER' then 'int' when 'BIGINT' then 'bigint' when 'DOUBLE' then 'double' else 'timestamp' end as column_type, true as fits, 0::bigint as n_rows from (select 'crawl_status' as table_name, column_name, column_type as data_type from (describe crawl_status) union all select 'part_status', column_name, column_type from (describe part_status))",
    "queue_mark_merging": f"select crawl_id, case when status = 'fetching' then 'merging' else status end as status, total_parts, success_parts, failed_parts, min_success_ratio_used, output_path, row_count, last_error, started_at, finished_at, created_at, case when status = 'fetching' then timestamptz '{NOW}+00' else updated_at end as updated_at from crawl_status",
    "queue_remaining_crawls": "select distinct crawl as crawl_id from crawl_index where crawl not in (select crawl_id from crawl_status where status = 'done')",
    "queue_seeded_crawls": "select distinct crawl_id from crawl_status",
    "queue_orphan_parts": "select id, crawl_id from part_status where crawl_id not in (select crawl_id from crawl_status where status = 'done')",
    "queue_mark_done": f"""with p as (select crawl_id, count(*)::int as t, (count(*) filter (status = 'success'))::int as g from part_status group by 1)
select crawl_id, 'done' as status, total_parts, case when was then success_parts else coalesce(g, 0) end as success_parts, case when was then failed_parts else coalesce(t - g, 0) end as failed_parts, case when was then min_success_ratio_used else 0.5 end::double as min_success_ratio_used,
case when was then output_path else 'out/' || crawl_id end as output_path, case when was then row_count else 5 end as row_count, case when was then last_error end as last_error, started_at, case when was then finished_at else timestamptz '{NOW}+00' end as finished_at, created_at, case when was then updated_at else timestamptz '{NOW}+00' end as updated_at
from (select *, status = 'done' as was from crawl_status) left join p using (crawl_id)""",
    "exact_dedup_removed": f"select * from ({SEL}) s where not exists (select 1 from ({DEDUP}) k where k.warc_filename = s.warc_filename and k.warc_record_offset = s.warc_record_offset)",
}
