import gzip
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from webloom.functions.encoding import undo_utf8
from webloom.functions.text import tokens
from webloom.operators import cleanup, html, language, manifest, minhash, queue, quality, repetition, url
from webloom.plans import manifest_run, pipeline, profile, publish
from webloom.plans.profile import GREEK, Profile
from webloom.sources import index, records

MANIFEST = "url string, url_host_registered_domain string, content_digest string, content_languages string, warc_filename string, warc_record_offset bigint, warc_record_length bigint"


def man(spark, data):
    return spark.createDataFrame(data, MANIFEST)


def test_exact_language_match(spark, rows):
    df = spark.createDataFrame([("ellx,eng",), ("eng,ell",), ("ell",), (None,), ("",)], "c string")
    assert rows(df.where(manifest.has_language(F.col("c"), "ell"))) == [("ell",), ("eng,ell",)]


def test_keep_first_with_ties_nulls_and_repeated_rows(spark, rows):
    df = man(spark, [("a", "d", "x", "ell", "f2", 1, 9), ("b", "d", "x", "ell", "f1", 5, 9), ("b", "d", "x", "ell", "f1", 5, 9), ("c", "d", None, None, "f3", 2, 9), ("e", "d", None, None, "f3", 1, 9)])
    assert rows(manifest.keep_first(df), "url") == [("b",), ("e",)]
    assert manifest.keep_first(df.where("false")).count() == 0
    halves = [manifest.keep_first(df.where(F.col("warc_record_offset") > 1)), manifest.keep_first(df.where(F.col("warc_record_offset") <= 1))]
    assert rows(manifest.keep_first(manifest.union(halves, spark))) == rows(manifest.keep_first(df))


def test_union_of_nothing_is_the_empty_manifest(spark):
    assert manifest.union([], spark).columns == manifest.COLUMNS
    assert index.scan(spark).count() == 0


def test_row_index_ranks_and_chunks(spark, rows):
    df = man(spark, [(str(i), "d", str(i), "ell", f"f{i % 3}", i, 1) for i in range(10)])
    numbered = manifest.with_row_index(df)
    assert [r[0] for r in rows(numbered, "row_idx")] == list(range(10))
    order = [r.url for r in numbered.orderBy("row_idx").collect()]
    assert order == [r.url for r in df.orderBy(*manifest.ORDER).collect()]
    assert sorted(Counter(r[0] for r in manifest.rank_of(numbered, 4, 10).select("rank").collect()).items()) == [(0, 3), (1, 3), (2, 2), (3, 2)]
    total = spark.createDataFrame([(250,)], "n_rows bigint")
    assert rows(manifest.chunk_bounds(total, 100), "start_row", "length") == [(0, 100), (100, 100), (200, 50)]
    assert manifest.chunk_bounds(total, 100, 250).count() == 0
    assert manifest.slice_rows(numbered, 3, 4).count() == 4 and manifest.slice_rows(numbered, 8).count() == 2


def test_rows_without_a_file_or_offset_are_numbered(spark, rows):
    df = man(spark, [("a", "d", "x", "ell", None, None, 9), ("b", "d", "y", "ell", "f", None, 9), ("c", "d", "z", "ell", "f", 2**29, 9), ("e", "d", "w", "ell", "f", 1, 9)])
    assert rows(manifest.with_row_index(df), "row_idx", "url") == [(0, "a"), (1, "b"), (2, "e"), (3, "c")]


def test_resume_point(spark):
    at = lambda xs: spark.createDataFrame([(x,) for x in xs], "start_row bigint")
    assert manifest.resume_row(at([])) == 0
    assert manifest.resume_row(at([200, 0, 100])) == 300
    for bad in ([0], [0, 100, 300], [100, 200]):
        with pytest.raises(ValueError):
            manifest.resume_row(at(bad))
    assert manifest.bucket_tasks(30) == 28 and manifest.bucket_tasks(3) == 14 and manifest.default_tasks(1) == 1


def test_chunk_names_and_stale_files(spark, rows):
    df = spark.createDataFrame([("chunk_000000000100.parquet", 5), ("chunk_x.parquet", 1), ("x/00000_00003.parquet", 9), ("00000_00001.parquet", 0)], "name string, size int")
    assert rows(index.published_chunks(df)) == [(100,)]
    assert {r[0] for r in df.select(index.file_kind(F.col("name"), F.col("size"), 3)).collect()} == {"keep", "stale", "empty"}


PARTS = "id bigint, crawl_id string, part_url string, part_index int, status string, fragment_path string, row_count bigint, attempt_count int, last_error string, started_at timestamp, finished_at timestamp, updated_at timestamp"


def test_queue(spark, rows):
    p = spark.createDataFrame([(1, "c1", "u1", 0, "pending", None, None, 0, None, None, None, None), (2, "c1", "u2", 1, "running", None, None, 5, None, None, None, None), (3, "c1", "u3", 2, "running", None, None, 4, None, None, None, None), (4, "c2", "u4", 0, "failed", None, None, 5, "x", None, None, None)], PARTS)
    now = F.current_timestamp()
    assert rows(queue.claim(p, 1, now).where("status = 'running'"), "id", "attempt_count") == [(1, 1), (2, 5), (3, 4)]
    assert rows(queue.mark_error(p, F.col("status") == "running", F.repeat(F.lit("e"), 5000)).where("id in (2, 3)"), "id", "status", F.length("last_error")) == [(2, "failed", 2000), (3, "pending", 2000)]
    assert rows(queue.requeue_failed(p, F.lit(True)).where("id = 4"), "status", "attempt_count") == [("pending", 0)]
    c = spark.createDataFrame([("c1", "fetching"), ("c2", "merging"), ("c3", "done")], "crawl_id string, status string")
    assert rows(queue.ready_crawls(c, p), "crawl_id") == [("c2",)]
    assert rows(queue.success_ratio(p), "crawl_id", "ratio") == [("c1", 0.0), ("c2", 0.0)]


def test_status_tables_keep_their_columns(spark, rows):
    now = F.to_timestamp(F.lit("2026-01-01"))
    crawls, parts = queue.empty_tables(spark)
    new = spark.createDataFrame([("c", "u1", 0), ("c", "u2", 1), ("c", "u2", 1)], "crawl_id string, part_url string, part_index int")
    parts = queue.register(parts, new, now)
    assert rows(parts, "id", "part_url", "status", "attempt_count") == [(1, "u1", "pending", 0), (2, "u2", "pending", 0)]
    parts = queue.mark_success(parts, F.col("id") == 1, F.lit("f"), F.lit(7), now)
    again = queue.register(parts, new.union(spark.createDataFrame([("c", "u3", 2)], new.schema)), now)
    assert rows(again, "id", "status") == [(1, "success"), (2, "pending"), (3, "pending")]
    crawls = queue.upsert_crawl(crawls, spark.createDataFrame([("c", 2)], "crawl_id string, total_parts int"), now)
    closed = queue.mark_error(parts, F.col("id") == 2, F.lit("e"), max_attempts=0)
    assert rows(queue.merge_gate(crawls, closed, 0.6), "crawl_id", "ratio", "action") == [("c", 0.5, "requeue")]
    assert rows(queue.merge_gate(crawls, closed, 0.5), "action") == [("merge",)]
    done = queue.mark_done(queue.mark_merging(crawls, F.lit(True), now), F.lit(True), closed, F.lit("o"), F.lit(9), 0.5, now)
    assert rows(done, "status", "total_parts", "success_parts", "failed_parts", "output_path", "row_count", "min_success_ratio_used") == [("done", 2, 1, 1, "o", 9, 0.5)]
    assert done.columns == crawls.columns and done.schema["started_at"].dataType.simpleString() == "timestamp"
    kept = queue.upsert_crawl(done, spark.createDataFrame([("c", 3)], "crawl_id string, total_parts int"), F.to_timestamp(F.lit("2027-01-01"))).first()
    assert (kept.status, kept.total_parts, kept.output_path, kept.started_at.year, kept.updated_at.year) == ("fetching", 3, "o", 2026, 2027)


def test_url_rules(spark):
    lists = Profile(blocked_domains=("bad.example",), blocked_hosts=("m.x.example",), hard_words=("amp",), soft_words=("a1", "b1"), banned_parts=("evil",))
    data = [("https://x.bad.example/", "bad.example"), ("https://M.X.example/", "x.example"), ("https://q.example/amp", "q.example"), ("https://q.example/a1/b1", "q.example"), ("https://q.example/e-v.il", "q.example"), ("https://q.example/ampere", "q.example"), (None, None)]
    df = spark.createDataFrame(data, "u string, d string")
    assert [r[0] for r in df.select(url.verdict(F.col("u"), F.col("d"), lists)).collect()] == ["domain", "host", "hard_word", "soft_words", "part", None, None]
    assert df.where(url.verdict(F.col("u"), F.col("d")).isNotNull()).count() == 0


def test_block_lists_as_tables(spark, rows):
    data = [("https://x.bad.example/", "bad.example"), ("https://M.X.example/", "x.example"), ("https://q.example/a", "q.example"), ("https://q.example/b", "q.example"), (None, None)]
    df = spark.createDataFrame(data, "url string, url_host_registered_domain string").withColumn("entry", F.lit(1))
    lists = {k: spark.createDataFrame([(x,) for x in v], "entry string") for k, v in {"domain": ["bad.example", "bad.example", None], "host": ["m.x.example"], "url": ["https://q.example/b"]}.items()}
    got = url.banned(df, lists, Profile(hard_words=("a",)))
    assert [r.ban for r in got.orderBy(F.col("url").asc_nulls_last()).collect()] == ["host", "hard_word", "url", "domain", None]
    assert got.columns == [*df.columns, "ban"]


def test_html(spark):
    page = "<html><head><title>t</title></head><body><nav>menu</nav><p>One &amp;amp; two<br>three<!-- c --><script>x</script><p>four five six seven</body>"
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id bigint, html string")
    got = [r[0] for r in df.orderBy("page_id").select(html.plain_text(F.col("html"))).collect()]
    assert got[0].split() == ["One", "&amp;", "two", "three", "four", "five", "six", "seven"] and got[1:] == [None, ""]
    assert html.main_text("<div><a href=x>all of this is one link</a></div>") is None
    assert [r.page_id for r in html.density(df).collect()] == [1]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<header>a</header><article>b</article><footer>c</footer>", "a\nb"),
        ("<aside>x<form>y</form>z</aside>tail", "tail"),
        ("<NAV class='m'>x</NAV ><p>one<br/>two</p>", "one\ntwo"),
        ("<pre>a  b</pre><link><p>c&nbsp;&lt;d&gt;</p>", "a b\nc <d>"),
    ],
)
def test_page_text_is_this(spark, page, text):
    assert spark.createDataFrame([(page,)], "html string").select(html.plain_text(F.col("html"))).first()[0] == text


def test_long_pages_are_read_whole_and_slow_ones_dropped():
    page = "<p>" + "λέξη " * 400_000 + "</p>" + "<p>x</p>" * 200_000 + "<p>the very last words here</p>"
    assert html.main_text(page).endswith("the very last words here")
    assert html.main_text(page, timeout=-1.0) is None


def test_language_cut(spark, rows):
    df = spark.createDataFrame([("ell", 0.826), ("ell", 0.8259), ("eng", 0.99), ("ell", None)], "language string, language_score double")
    assert rows(language.above_threshold(df)) == [("ell", 0.826)]
    texts = spark.createDataFrame([(1, "το παιδί και η γάτα είναι στην αυλή"), (2, None), (3, "the cat and the dog")], "doc_id bigint, text string")
    assert rows(language.scores(texts), "doc_id", "language", "language_script") == [(1, "ell", "Grek"), (2, "und", "Zyyy"), (3, "eng", "Latn")]
    near = spark.createDataFrame([("ell", 0.8259996)], "language string, language_score double")
    assert language.above_threshold(near).count() == 0
    own = language.scores(texts, scorer=lambda: lambda text, tokens: [("x", 0.5 if text else 0.0)])
    assert rows(own, "doc_id", "language", "language_score") == [(1, "x", 0.5), (2, "und", 0.0), (3, "x", 0.5)]


def greedy(words, n):
    seen, total, i = set(), 0, 0
    while i + n <= len(words):
        g = "\0".join(words[i : i + n])
        if g in seen:
            total += sum(len(w) for w in words[i : i + n])
            i += n
        else:
            seen.add(g)
            i += 1
    return total


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from("a bb ccc d".split()), max_size=40), st.integers(2, 6))
def test_ngrams_against_plain_versions(words, n):
    assert repetition.dup_ngram_chars(words, n) == greedy(words, n)
    grams = [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    want = 0
    if grams:
        most = max(Counter(grams).values())
        first = next(g for g in grams if grams.count(g) == most)
        want = len(first) * most
    assert repetition.top_ngram_chars(words, n) == want


def test_greedy_fixture_and_tie():
    assert repetition.dup_ngram_chars("a b c d e a b c d e".split(), 5) == 5
    assert repetition.top_ngram_chars("xx y xx y z zzzz z zzzz".split(), 2) == 8


def test_reasons_of_empty_null_and_long_texts(spark):
    texts = [(1, None), (2, ""), (3, "... !!"), (4, "λέξη " * 200_000), (5, "\n".join(["ίδια γραμμή"] * 4 + [f"γραμμή {i}" for i in range(6)]))]
    df = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("language", F.lit("mine"))
    df = df.withColumnRenamed("language", "w")
    got = {r.doc_id: r for r in quality.judged(df, by_language=False).collect()}
    assert got[1].reason == got[2].reason == "empty" and got[4].reason is not None and got[5].w == "mine"
    assert got[5].reason not in ("dup_line_frac", "dup_para_frac")
    assert {r.reason for r in quality.judged(df.where("doc_id = 5"), Profile(dup_line_frac=0.29), by_language=False).collect()} == {"dup_line_frac"}
    shares = repetition.repeated_pieces(df).where("doc_id = 5").first()
    assert shares.dup_line_frac == 0.3


def test_one_pass_agrees_with_the_columns(spark):
    """The reasons of the Arrow pass are those of the measures as built-in expressions."""
    r = random.Random(9)
    pool = ["και", "το", "η", "λέξη", "#", "...", "…", "a1", "7", ".", "!", "-", "πολύ", "μεγάλη", "_x"]
    make = lambda: "\n".join(r.choice(["", "• ", "- ", " "]) + " ".join(r.choice(pool) for _ in range(r.randrange(12))) + r.choice(["", ".", "…", "... ", ". \t"]) for _ in range(r.randrange(14)))
    df = spark.createDataFrame([(i, make()) for i in range(300)], "doc_id bigint, text string")
    p = Profile(min_words=20, min_avg_word_length=2, line_punct=0.3, char_dup=0.3, new_line_ratio=0.3, dup_line_frac=0.6, max_bullet_frac=0.7, min_alpha_ratio=0.6, short_line_frac=0.9, short_line_length=9)
    c = quality.word_measures(quality.line_measures(df.select("*", *repetition.piece_columns()), p), p)
    tests = [("dup_line_frac", F.col("dup_line_frac") > 0.6), ("empty", F.col("n_lines") == 0), ("line_punct", F.col("terminal_frac") < 0.3), ("short_lines", F.col("short_frac") > 0.9), ("char_dup", F.col("char_dup_frac") > 0.3), ("new_lines", F.col("new_line_ratio") > 0.3), ("few_words", F.col("n_words") < 20), ("word_length", ~F.col("avg_word_length").between(2, 11)), ("hashes", F.col("hash_ratio") > 0.1), ("ellipses", F.col("ellipsis_ratio") > 0.1), ("bullets", F.col("bullet_frac") > 0.7), ("ellipsis_lines", F.col("ellipsis_frac") > 0.3), ("alpha", F.col("alpha_ratio") < 0.6), ("stop_words", F.col("n_stop_words") < 2)]
    want = {x.doc_id: x.reason for x in c.withColumn("reason", F.coalesce(*[F.when(t, F.lit(n)) for n, t in tests])).collect()}
    got = {x.doc_id: x.reason for x in quality.judged(df, p, n_grams=False, by_language=False).collect()}
    assert got == want and len(set(want.values())) > 6


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("mail x@y.example 10.0.0.1 8.8.8.8 end", "mail <email> 10.0.0.1 <ip> end"),
        ("8.8.8.8 1.1.1.1 9.9.9.9", "<ip> <ip> <ip>"),
        ("is 8.8.8.8. Next", "is <ip>. Next"),
        ("8.8.8.8,1.1.1.1", "<ip>,<ip>"),
        ("1.2.3.4.5 and 18.8.8.888 and 192.168.1.1 and 172.16.0.1 and 172.32.0.1", "1.2.3.4.5 and 18.8.8.888 and 192.168.1.1 and 172.16.0.1 and <ip>"),
        (None, None),
    ],
)
def test_redaction_is_this(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(cleanup.redact_addresses(F.col("t"))).first()[0] == want


@pytest.mark.parametrize(("text", "want"), [("a\n|\n|\nb", "a\nb"), ("|\nb", "\nb"), ("a\n||", "a\n"), ("a|\nb", "a|\nb"), ("a\n\n|\n\nb", "a\n\n\nb")])
def test_symbol_lines_are_these(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(cleanup.symbol_lines(F.col("t"))).first()[0] == want
    assert cleanup.format_text(text) == want


def misread(byte, encoding):
    try:
        return bytes([byte]).decode(encoding)
    except UnicodeDecodeError:
        return chr(byte)


def test_repair(spark):
    assert cleanup.repair_text("x &amp;lt; y\ufeff\x07 &#8217;&#x2019; &eacute; &nosuch; &#150;\r\nz\x1b[31m") == "x < y ’’ é &nosuch; –\nz"
    df = spark.createDataFrame([("a &amp; b", 1), (None, 2)], "text string, n int")
    assert [tuple(r) for r in cleanup.repaired(df).orderBy("n").collect()] == [("a & b", 1), (None, 2)]
    greek = "Το νερό και η γάτα"
    for read_as in ("cp1252", "latin-1", "cp1253", "iso8859-7"):
        raw = "".join(misread(b, read_as) for b in "γάτα λευκή".encode())
        assert undo_utf8(raw) == "γάτα λευκή", read_as
    for fine in (greek, "Ο·τι «Ξένο» café naïve Ångström", "Ο « Ξ»"):
        assert undo_utf8(fine) == fine


def test_tokens(spark):
    df = spark.createDataFrame([("Γεια, κόσμε_1!",)], "t string")
    assert df.select(tokens(F.col("t"))).first()[0] == ["Γεια", ",", "κόσμε_1", "!"]


def test_components_of_random_graphs(spark, rows):
    r = random.Random(3)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 140)]
    edges = [(min(e), max(e)) for e in edges if e[0] != e[1]]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    assert rows(minhash.components(spark.createDataFrame(edges, "u bigint, v bigint"))) == sorted((x, find(x)) for x in list(parent))
    assert minhash.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


@pytest.mark.parametrize("portable", [False, True])
def test_minhash_clusters(spark, rows, portable):
    text = " ".join(f"λέξη{i}" for i in range(80))
    docs = spark.createDataFrame([(1, text, "f", 3), (2, text, "f", 1), (3, text.upper(), "f", 2), (4, "τρεις μόνο λέξεις", "f", 4), (5, None, "f", 5), (6, "τρεις μόνο λέξεις", "f", 6)], "doc_id bigint, text string, warc_filename string, warc_record_offset bigint")
    got = minhash.clusters(docs, portable, None if portable else 0.8)
    assert rows(got) == [(1, 1, 3), (2, 1, 3), (3, 1, 3), (4, 4, 1), (5, 5, 1), (6, 6, 1)]
    kept = minhash.keep_one(docs, got)
    assert rows(kept, "doc_id") == [(2,), (4,), (5,), (6,)]
    assert rows(minhash.removed(docs, kept), "doc_id") == [(1,), (3,)]


def jaccard(a, b):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (minhash.normal_words(x) for x in (a, b))]
    return len(sets[0] & sets[1]) / max(len(sets[0] | sets[1]), 1)


def test_clusters_are_components_of_similar_pairs_of_a_bucket(spark, rows):
    """Against all pairs that share a band: near texts of many degrees, copies, chains and a bucket with many clusters."""
    r = random.Random(6)
    word = lambda: "".join(r.choice("αβγδεζηθ") for _ in range(7))
    texts = []
    for _ in range(4):
        base = [word() for _ in range(120)]
        for _ in range(7):
            ws = list(base)
            for _ in range(r.choice([0, 1, 2, 3, 5])):
                ws[r.randrange(len(ws))] = word()
            texts.append(" ".join(ws))
    docs = spark.createDataFrame([(i, t, "f", i) for i, t in enumerate(texts)], "doc_id bigint, text string, warc_filename string, warc_record_offset bigint")
    buckets = {}
    for x in minhash.sketches(docs).collect():
        for b in x.buckets:
            buckets.setdefault(bytes(b), set()).add(x.doc_id)
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for own in buckets.values():
        for u in own:
            for v in own:
                if u < v and jaccard(texts[u], texts[v]) >= 0.8:
                    a, b = find(u), find(v)
                    parent[max(a, b)] = min(a, b)
    got = {x.doc_id: x.cluster_id for x in minhash.clusters(docs).collect()}
    assert got == {i: find(i) for i in range(len(texts))}
    assert 4 < len(set(got.values())) < len(texts)


def test_hot_bucket_is_one_component(spark, rows):
    edges = spark.createDataFrame([(0, i) for i in range(1, 3000)] + [(2999, 3000), (3000, 3001)], "u bigint, v bigint")
    got = rows(minhash.components(edges))
    assert len(got) == 3002 and {c for _, c in got} == {0}


def test_records(spark, tmp_path, rows):
    def member(body):
        return gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + body + b"\r\n\r\n")

    one, two = member("πρώτο".encode()), member("δεύτερο".encode())
    (tmp_path / "a.warc.gz").write_bytes(one + two + b"not a record")
    n = len(one)
    data = [("u1", "d", "h1", "ell", "a.warc.gz", 0, n), ("u2", "d", "h2", "ell", "a.warc.gz", n, len(two)), ("u3", "d", "h3", "ell", "a.warc.gz", n + len(two), 12)]
    got = records.read_records(man(spark, data), "CC", records.local_fetch(str(tmp_path)), attempts=2, base=0.0)
    assert rows(got, "id", "text") == [("h1", "πρώτο"), ("h2", "δεύτερο")]
    carried = records.read_records(man(spark, data).withColumn("chunk", F.lit(7)), "CC", records.backend(str(tmp_path)), base=0.0, carry=("chunk",), extract=lambda t: t.upper() if t[0] == "π" else None)
    assert rows(carried, "text", "chunk") == [("ΠΡΏΤΟ", 7)]
    calls = []

    def failing(*_):
        calls.append(1)
        raise OSError("no")

    with pytest.raises(OSError):
        records.with_retry(failing, 3, 0.0, lambda _: None)("k", 0, 1)
    assert len(calls) == 3


def test_fetch_over_http(tmp_path):
    import functools
    import http.server
    import threading

    (tmp_path / "a b").write_bytes(bytes(range(100)))
    quiet = type("Quiet", (http.server.SimpleHTTPRequestHandler,), {"log_message": lambda *_: None})
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), functools.partial(quiet, directory=str(tmp_path)))
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        fetch = records.backend(f"http://127.0.0.1:{server.server_port}/")()
        assert fetch("a b", 10, 19) == bytes(range(10, 20))  # a server that knows no ranges sends all
        with pytest.raises(OSError):
            fetch("missing", 0, 1)
        assert fetch("a b", 0, 0) == b"\0"
    finally:
        server.shutdown()
    with pytest.raises(RuntimeError):
        records.backend("s3://bucket")()


def test_settings_from_files(tmp_path):
    (tmp_path / "s.json").write_text('{"language_score": 0.5, "top_n_grams": [[2, 0.3]], "stopwords": ["και"], "line_punct_thr": 0.2}')
    (tmp_path / "s.yml").write_text("language_score: 0.5\ntop_n_grams:\n- - 2\n  - 0.3\nstopwords:\n- \"\\u03BA\\u03B1\\u03B9\"\nline_punct_thr: 0.2\n")
    for name in ("s.json", "s.yml"):
        p = profile.load(str(tmp_path / name))
        assert (p.language_score, p.top_n_grams, p.stop_words, p.line_punct, p.char_dup) == (0.5, ((2, 0.3),), ("και",), 0.2, 0.1)
    (tmp_path / "bad.json").write_text('{"nothing": 1}')
    with pytest.raises(ValueError):
        profile.load(str(tmp_path / "bad.json"))


def test_publish(spark, tmp_path):
    df = spark.createDataFrame([(1, "c", 0), (2, "c", 100)], "doc_id bigint, crawl string, chunk bigint")
    out = str(tmp_path / "out")
    publish.write_chunks(df, out)
    publish.write_chunks(df.where("chunk = 100").withColumn("doc_id", F.lit(9).cast("bigint")), out)
    assert sorted(r.doc_id for r in spark.read.parquet(out).collect()) == [1, 9]
    target = publish.Publisher(spark, str(tmp_path / "target"))
    assert len(target.publish(f"{out}/crawl=c", "s/crawl=c")) == 2
    assert target.chunks("s/crawl=c") == {0, 100}
    assert len(target.fetch("s/crawl=c/chunk=100", str(tmp_path / "back"))) == 1
    assert spark.read.parquet(str(tmp_path / "back")).count() == 1
    target.publish(f"{out}/crawl=c/chunk=0", "s/crawl=c", clean=True)
    assert target.chunks("s/crawl=c") == set() or spark.read.parquet(str(tmp_path / "target" / "s")).count() == 1
    assert not (tmp_path / "out" / "crawl=c" / "chunk=0").exists()
    with pytest.warns(UserWarning):
        assert publish.Publisher(spark, None).publish(out, "p") == []
    for call in (lambda p: p.fetch("x", str(tmp_path)), lambda p: p.chunks("x")):
        with pytest.raises(FileNotFoundError):
            call(publish.Publisher(spark, None))


def test_manifest_of_a_crawl_end_to_end(spark, tmp_path, rows):
    data = [("u1", "d", "x", "ell", "text/html", 200, "f", 5, 1), ("u2", "d", "x", "eng,ell", "text/html", 200, "f", 3, 1), ("u3", "d", "y", "eng", "text/html", 200, "f", 4, 1), ("u4", "d", "z", "ell", "text/html", 200, "e", 4, 1)]
    part = spark.createDataFrame(data, index.INDEX)
    for k in (0, 1):
        part.where(f"pmod(warc_record_offset, 2) = {k}").write.parquet(str(tmp_path / f"crawl=c1/subset=warc/p{k}.parquet"))
    (tmp_path / "paths").write_text("".join(f"crawl=c1/subset={s}/p{k}.parquet\n" for s in ("warc", "robotstxt") for k in (0, 1, 2)))
    paths = lambda crawl: index.part_paths(index.path_list(spark, str(tmp_path / "paths")), crawl, str(tmp_path))
    publisher = publish.Publisher(spark, str(tmp_path / "pub"))
    run = lambda ratio=1.0, limit=1: manifest_run.run_once(spark, str(tmp_path / "state"), str(tmp_path / "out"), ["c1"], paths, limit, ratio, publisher, clean=True)
    first = run()
    assert (first["seeded"], first["fetched"], first["merged"]) == ("c1", 1, None)
    assert [run()["fetched"], run()["failed"]] == [1, 1]  # the third part is not there
    tables = manifest_run.Tables(spark, str(tmp_path / "state"))
    assert rows(tables.get("parts"), "part_index", "status", "row_count", "attempt_count") == [(0, "success", 1, 1), (1, "success", 2, 1), (2, "pending", None, 1)]
    assert [run()["failed"] for _ in range(3)] == [1, 1, 1]
    last = run()
    assert (last["failed"], last["requeued"]) == (1, "c1")  # two of three parts are too few
    assert [run(0.6)["failed"] for _ in range(4)] == [1] * 4
    done = run(0.6)
    assert (done["merged"], done["rows"]) == ("c1", 2)
    assert [r.url for r in spark.read.parquet(str(tmp_path / "pub/manifests/c1.parquet")).collect()] == ["u4", "u2"]
    assert not (tmp_path / "out" / "c1.parquet").exists() and not (tmp_path / "out" / "c1").exists()
    assert rows(tables.get("crawls"), "status", "success_parts", "failed_parts", "row_count") == [("done", 2, 1, 2)]
    assert run()["seeded"] is None


def test_stream_takes_each_digest_once(spark, tmp_path):
    from webloom.streaming import fragments

    schema = "url string, content_digest string, content_languages string, content_mime_detected string, fetch_status int, fetch_time timestamp"
    data = [("a", "x", "ell", "text/html", 200, "2024-01-01"), ("b", "x", "ell", "text/html", 200, "2024-01-02"), ("c", "y", "eng", "text/html", 200, "2024-01-02")]
    spark.createDataFrame(data, schema.replace("timestamp", "string")).withColumn("fetch_time", F.col("fetch_time").cast("timestamp")).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        fragments.run_available(fragments.new_records(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_pipeline_reasons_in_order(spark):
    data = [(1, "https://x.example/", "x.example", "the cat and the dog"), (2, "https://x.example/", "x.example", None)]
    docs = spark.createDataFrame(data, "doc_id bigint, url string, url_host_registered_domain string, text string")
    assert {r.doc_id: r.reason for r in pipeline.reasons(docs).collect()} == {1: "language", 2: "language"}
    banned = Profile(blocked_domains=("x.example",))
    assert {r.reason for r in pipeline.reasons(docs, banned).collect()} == {"url_domain"}
    assert GREEK.dup_para_frac == 0


def test_command_line_from_records_to_corpus(spark, tmp_path):
    from webloom import cli

    def body(seed):
        r = random.Random(seed)
        word = lambda: "".join(r.choice("αβγδεζηθικλμνξοπρστυφχψω") for _ in range(r.randrange(4, 10)))
        return "".join("<p>" + " ".join(f"{r.choice(GREEK.stop_words)} {word()}" for _ in range(9)) + " τέλος.</p>" for _ in range(9))

    bodies = [f"<html><body>{body(k)}</body></html>" for k in (1, 1, 5)] + ["<p>λίγα</p>"]
    at, data, blob = 0, [], b""
    for n, body in enumerate(bodies):
        one = gzip.compress(b"WARC/1.0\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body.encode() + b"\r\n\r\n")
        data.append((f"https://x.example/{n}", "x.example", f"h{n}", "ell", "a.gz", at, len(one)))
        blob += one
        at += len(one)
    (tmp_path / "a.gz").write_bytes(blob)
    man(spark, data).write.parquet(str(tmp_path / "m"))
    call = ["CC", "--manifest", str(tmp_path / "m"), "--records", str(tmp_path), "--out-dir", str(tmp_path / "out"), "--chunk-size", "2", "--chunks-per-job", "1", "--tasks", "2", "--publish-to", str(tmp_path / "pub")]
    got = cli.main(call)
    assert got["survivors"] - got["removed"] == got["final"]
    assert got["final"] >= 1 and got["removed"] >= 1
    assert cli.main(call) == {}
    final = spark.read.parquet(str(tmp_path / "out/CC/final"))
    assert final.columns == [*[x.split()[0] for x in publish.STAGE.split(", ")], "cluster_id", "cluster_size"] and {r.language_script for r in final.collect()} == {"Grek"}
    # A run that was killed after its chunks were done fetches none of them again.
    import shutil

    shutil.rmtree(tmp_path / "out/CC/final")
    assert cli.main([*call[:4], str(tmp_path / "nothing"), *call[5:]]) == got
    # A run on another machine takes the published chunks and goes on after them.
    elsewhere = [*call[:5], "--out-dir", str(tmp_path / "out2"), "--chunk-size", "1", "--publish-to", str(tmp_path / "pub")]
    (tmp_path / "pub/stage-1/crawl=CC/chunk=2").mkdir(exist_ok=True)  # a chunk without survivors is published as none
    src = next((tmp_path / "pub/stage-1/crawl=CC/chunk=0").glob("*.parquet"))
    if not list((tmp_path / "pub/stage-1/crawl=CC/chunk=2").glob("*.parquet")):
        shutil.copy(src, tmp_path / "pub/stage-1/crawl=CC/chunk=2" / src.name)
    resumed = cli.main([*elsewhere, "--skip-published"])
    assert resumed["final"] == got["final"]
    # Another chunk size leaves no document twice; neither does a run from the start.
    assert cli.main([*call[:7], "--chunk-size", "3", "--force"])["survivors"] == got["survivors"]
    (tmp_path / "lists").mkdir()
    (tmp_path / "lists" / "url.txt").write_text("https://x.example/2\nhttps://elsewhere.example/\n")
    assert cli.main([*call[:7], "--block-lists", str(tmp_path / "lists"), "--force"])["survivors"] == got["survivors"] - 1


def test_records_are_fetched_once(spark, tmp_path):
    from webloom import cli

    rows = publish.with_chunk(manifest.with_row_index(man(spark, [("u", "d", "h", "ell", "a.gz", 0, 1)])), 2)
    plan = cli.extracted(rows, "CC", str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "Join" not in plan.split("MapInArrow")[1]


def test_checkpoints_need_a_shared_folder(spark):
    from webloom import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(dict)

    class Session:
        sparkContext = Context

    with pytest.raises(RuntimeError):
        session.shared_folder(Session)
