import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from webloom.llm import boilerplate, language, leakage, mixing, mojibake, pii, quality, reading, repetition, site_lines
from webloom.llm.common import words

DOCS = "doc_id bigint, text string, url string, url_host_registered_domain string, source string, warc_filename string, warc_record_offset bigint, gone int, hash string, rows int, label string"


def frame(spark, texts, site="s.example"):
    """Documents with extra columns whose names clash with those the operators make."""
    return spark.createDataFrame([(i, t, f"u{i}", site, "News ", "f", i, 1, "h", 2, "l") for i, t in enumerate(texts, 1)], DOCS)


def greek(seed, n):
    r = random.Random(seed)
    return " ".join("".join(r.choice("αβγδεζηθικλμνξοπρστυφχψω") for _ in range(r.randrange(3, 9))) for _ in range(n))


EDGE = [None, "", " \n\t\n", "λ"]


def test_words_fold():
    assert words("ΟΔΥΣΣΕΥΣ, οδυσσεύς free-text x") == ["οδυσσευσ", "οδυσσευσ", "freetext", "x"]


@pytest.mark.parametrize(
    ("line", "kinds"),
    [
        ("Γράψτε στο info παπάκι ormos τελεία test.", {"email"}),
        ("write to a.b[at]x[dot]invalid now", {"email"}),
        ("kalv+a at ormos dot test", {"email"}),
        ("petros . x @ mail.x . example", {"email"}),
        ("Τιμή: 985,94 € @ τεμάχιο, ακολουθήστε @nea", set()),
        ("Τηλ.: (+30) 2810-072550", {"phone"}),
        ("Καλέστε έξι εννέα οκτώ μηδέν ένα δύο τρία τέσσερα πέντε έξι", {"phone"}),
        ("8318 5179 3157 6139 5913 8459", set()),
        ("Ο κωδικός είναι 564727415 και η παρτίδα 3973-3973", set()),
        ("ΑΦΜ 009825500", {"id_number"}),
        ("Α.Μ.Κ.Α. 150374-26025.", {"id_number"}),
        ("αριθμός ταυτότητας ΑΖ-008933", {"id_number"}),
        ("επί της οδού Πηγών, αριθμός 106β", {"address"}),
        ("Θυμαριού 27β & Μύρτου, Τ.Κ. 76122", {"address"}),
        ("Στην πλατεία υπάρχουν 79 λαοί", set()),
        ("Η κατάθεση της Χλόης Ξυδουνοπούλου", {"name"}),
        ("Γράφει: Μ. Βρακουνίδης", {"name"}),
        ("Ο ΛΟΥΚΑΣ ΣΚΑΡΠΟΡΙΔΗΣ μίλησε", {"name"}),
        ("Ο Νίκος γελά. Η Λένα μένει", set()),
        ("Στο Αετοχώρι", set()),
        ("γράψτε στο info{at}ormos{dot}test", {"email"}),
        ("γράψτε στο info<at>ormos.test", {"email"}),
        ("γράψτε στο info [AT] ormos [DOT] test", {"email"}),
        ("στείλτε στο info＠ormos.test", {"email"}),
        ("στείλτε στο info@παράδειγμα.ελ", {"email"}),
        ("στείλτε στο infο@ormos.test", {"email"}),  # a Greek omicron
        ("εξι εννεα οκτω μηδεν ενα δυο τρια τεσσερα πεντε εξι", {"phone"}),
        ("call +44 20 7946 0958", {"phone"}),
        ("rufen Sie +49 (0)30 901820", {"phone"}),
        ("από +357 22 123456 ή", {"phone"}),
        ("τηλ. 210–123–4567", {"phone"}),
        ("τηλ. 2310 Ο34608", {"phone"}),
        ("στον 5ο όροφο και στις 12 Ο καιρός", set()),
        ("στην οδού Πηγών αρ. 106", {"address"}),
        ("Ερμού 15, Αθήνα", {"address"}),
        ("John Smith lives here", {"name"}),
        ("Hans Müller schreibt", {"name"}),
        ("пише Мария Иванова днес", {"name"}),
        ("γράφει ο Giorgos Papadopoulos", {"name"}),
        ("Η Ελένη Βενιζέλου και ο Οδυσσέας Ελύτης", {"name"}),
        ("ο Nίκος Παπαδόπουλος", {"name"}),  # a Latin N
        ("Η Μαρι\u0301α Παπαδοπου\u0301λου μίλησε", {"name"}),
        ("Η Ελένη μένει. Ο Μάρκος γελά", set()),
        ("The Smith and his House", set()),
    ],
)
def test_personal_information(line, kinds):
    assert {t for _, _, t in pii.detect(line)} == kinds


def test_redaction_keeps_the_rest_and_maps_back():
    line = "Γράψτε στο info παπάκι ormos τελεία test, τηλ. 2310 034608 ή ελάτε."
    assert pii.redact_line(line)[0] == "Γράψτε στο [EMAIL], τηλ. [PHONE] ή ελάτε."
    assert pii.redact_line("τίποτα εδώ") == ("τίποτα εδώ", 0)


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ("call six nine four one two three four five six seven", "call [PHONE]"),
        ("Καλέστε έξι εννέα οκτώ μηδέν ένα δύο τρία τέσσερα πέντε έξι", "Καλέστε [PHONE]"),
        ("έξι εννέα οκτώ μηδέν ένα δύο τρία τέσσερα πέντε έξι, ελάτε", "[PHONE], ελάτε"),
        ("Η Μαρι\u0301α Παπαδοπου\u0301λου μίλησε", "Η [NAME] μίλησε"),
        ("στο info [at] ormos [dot] test και μετά", "στο [EMAIL] και μετά"),
        ("τηλ. 693Ο123456 ή ΑΦΜ 009825500.", "τηλ. [PHONE] ή ΑΦΜ [ID_NUMBER]."),
        ("ο Nίκος Παπαδόπουλος, οδός Πηγών 106, x@y.test", "ο [NAME], [ADDRESS], [EMAIL]"),
    ],
)
def test_redacted_lines_are_these(line, want):
    assert pii.redact_line(line)[0] == want


def test_spans_map_back_to_the_source():
    line = "α\u0301 six nine four one two three four five six seven b at ormos dot test."
    spans = {t: line[a:b] for a, b, t in pii.detect(line)}
    assert spans == {"phone": "six nine four one two three four five six seven", "email": "b at ormos dot test"}


PIECES = ["info", "at", "[at]", "{dot}", "παπάκι", "τελεία", "@", ".", "ormos", "test", "2310", "034608", "Ο34", "+30", "έξι", "εννέα", "one", "two", "οδός", "Πηγών", "12", ",", "ΑΦΜ", "009825500", "Μαρία", "Παπαδοπούλου", "Μ.", "John", "Smith", "Αθήνα", "104 32", "street", "\u0301", "Nίκος", "Κωνσταντινίδης"]


def test_no_gate_of_a_detector_loses_what_it_finds(monkeypatch):
    r = random.Random(11)
    lines = [r.choice(["", " "]).join(r.choice(PIECES) + r.choice(["", " ", " ", " "]) for _ in range(r.randrange(1, 14))) for _ in range(4000)]
    gated = [pii.detect(x) for x in lines]
    anything = __import__("re").compile("")
    for gate in ("_HAS_DIGITS", "_PLACE", "_CAPITALS", "_DIGIT"):
        monkeypatch.setattr(pii, gate, anything)
    assert [pii.detect(x) for x in lines] == gated
    assert {t for x in gated for _, _, t in x} == set(pii.TYPES)


def test_pii_edges(spark, rows):
    df = frame(spark, [*EDGE, "x a@b.example\n\na@b.example c@d.example", "w " * 100_000 + "a@b.example"])
    assert rows(pii.found(df)) == [(5, 1, "email"), (5, 3, "email"), (6, 1, "email")]
    assert pii.redacted(df).count() == 6
    assert pii.found(df.where("false")).count() == 0


def plain_repeats(ws, n=5):
    seen, hit = set(), set()
    for i in range(len(ws) - n + 1):
        g = tuple(ws[i : i + n])
        if g in seen:
            hit |= set(range(i, i + n))
        seen.add(g)
    return len(hit)


def test_repetition(spark, rows):
    r = random.Random(1)
    for _ in range(50):
        ws = [r.choice("abc") for _ in range(r.randrange(40))]
        assert repetition.repeated_words(repetition.number_words(ws)) == plain_repeats(ws)
    half = greek(1, 60)
    df = frame(spark, [*EDGE, half + "\n" + half.upper(), greek(2, 200), "α β γ δ ε " * 50_000])
    got = {x.doc_id: x for x in repetition.measure(df).collect()}
    assert [i for i, x in got.items() if x.verdict == "repetitive"] == [5, 7]
    assert got[1].verdict == got[2].verdict == "empty" and got[6].repeated_share == 0
    assert repetition.measure(df.where("false")).count() == repetition.bands(df.where("false")).count() == 0
    assert repetition.bands(df).count() == 7


@pytest.mark.parametrize("run", [5, 7, 30])
def test_bands_pass_every_document_with_a_third_repeated(run):
    """Random words are the hardest case: nothing but the repeated runs can be saved."""
    for n in (40, 150, 700, 2500):
        for letters in ("αβγδεζηθικλμνξοπρστυφχψω", "abcdefghijklmnopqrstuvwxyz0123456789", "ab"):
            r = random.Random(f"{n}{letters}{run}")
            ws = ["".join(r.choice(letters) for _ in range(r.randrange(3, 9))) + str(k) * (letters == "ab") for k in range(n)]
            step = max(1, n // 40)
            out = list(ws)
            while plain_repeats(out) * 3 < len(out):
                for _ in range(step):
                    at = r.randrange(n - run)
                    out += [*ws[at : at + run], f"q{len(out)}"]
            codes = repetition.run_codes(repetition.number_words(out))
            data = codes.tobytes()
            assert len(repetition.compressor(len(data)).compress(data)) / len(data) <= repetition.limit(len(codes))


def test_bands_reject_what_does_not_repeat():
    ws = greek(5, 20_000).split()
    codes = repetition.run_codes(repetition.number_words(ws))
    data = codes.tobytes()
    assert len(repetition.compressor(len(data)).compress(data)) / len(data) > repetition.limit(len(codes))
    assert repetition.limit(100) == repetition.limit(1 << 25) == float("inf")


def test_repeats_far_apart_and_in_short_words_are_found(spark):
    r = random.Random(3)
    token = lambda letters, lo, hi: "".join(r.choice(letters) for _ in range(r.randrange(lo, hi)))
    tokens = [token("abcdefghijklmnopqrstuvwxyz0123456789", 3, 12) for _ in range(2000)]
    short = [token("abcdefghijklmnopqrstuvwxyz", 1, 4) for _ in range(3000)]
    far = [token("abcdefghijklmnopqrstuvwxyz", 6, 14) for _ in range(700_000)]
    texts = [tokens + tokens[:1100], short + short[:1900], far + far]
    assert len(" ".join(texts[2])) > 14_000_000
    got = {x.doc_id: x for x in repetition.measure(frame(spark, [" ".join(x) for x in texts]), every=False).collect()}
    assert {x.verdict for x in got.values()} == {"repetitive"}
    assert got[3].repeated_share == 0.5 and got[1].repeated_share > 0.354 and got[2].repeated_share > 0.377


def test_share_is_exact_above_the_limit(spark):
    ws = greek(7, 4000).split()
    ws += ws[:40]
    got = repetition.measure(frame(spark, [" ".join(ws)])).first()
    assert got.run_ratio > repetition.limit(len(ws) - 4)
    assert got.verdict == "normal" and got.repeated_share == pytest.approx(plain_repeats(ws) / len(ws)) and got.repeated_share > 0.009
    assert repetition.measure(frame(spark, [" ".join(ws)]), every=False).first().repeated_share is None


def test_last_chunk_is_read():
    import zstandard

    compress = zstandard.ZstdCompressor(level=3).compress
    data = np.random.default_rng(1).bytes(repetition.CHUNK_BYTES) + b"a" * (repetition.CHUNK_BYTES - 1)
    _, least, mean = repetition.ratios(compress, data)
    assert least < 0.05 and 0.4 < mean < 0.6


def test_site_lines(spark, rows):
    texts = [f"Όροι  χρήσης {i} της σελίδας\nμοναδική γραμμή {greek(i, 4)}" for i in range(4)] + ["ΟΡΟΙ ΧΡΗΣΗΣ 77 ΤΗΣ ΣΕΛΙΔΑΣ \n\nάλλο", *EDGE]
    df = frame(spark, texts)
    assert rows(site_lines.found(df)) == [(i, 1) for i in range(1, 6)]
    clean = {r.doc_id: r for r in site_lines.cleaned(df).collect()}
    assert clean[5].text == "\nάλλο" and clean[6].text is None and clean[7].text == "" and len(clean) == 9
    assert site_lines.found(frame(spark, texts, None)).count() == 0
    marked = frame(spark, ["Ὅροι τῆς Σελίδος", "Ὅροι της σελίδος", "Όροι της σελι\u0301δος", "όροι της ΣΕΛΙΔΟΣ", "οροι τησ σελιδοσ", *[greek(k, 3) for k in range(20)]])
    assert rows(site_lines.found(marked)) == [(k, 1) for k in range(1, 6)]
    assert site_lines.found(marked, min_share=0.3).count() == 0 and site_lines.found(marked, min_share=0.2).count() == 5
    assert [(r.line, r.n_documents, r.document_share) for r in site_lines.report(marked).collect()] == [("Ὅροι τῆς Σελίδος", 5, 0.2)]
    twice = frame(spark, ["η ίδια μεγάλη γραμμή\n" * 9])
    assert site_lines.found(twice).count() == 0


def test_mojibake(spark, rows):
    lines = ["Το άγνωστο νερό άνοιξε τον λευκό συντονισμό στη μεγάλη πλατεία της πόλης", "Ο καιρός γράφει την ιστορία των ανθρώπων και των δρόμων"]
    clean = [greek(i, 30) + ". " + lines[i % 2] for i in range(400)]
    bad = [lines[0].encode().decode("cp1252", "replace").replace("�", "\x81"), lines[1].encode("iso8859-7").decode("latin-1"), "ένα � εδώ"]
    df = frame(spark, clean + bad + EDGE)
    got = {r.doc_id: r for r in mojibake.damaged_lines(df).collect()}
    assert set(got) == {401, 402, 403} and got[402].restored == lines[1] and not got[403].complete
    assert mojibake.invert(lines[0].encode().decode("latin-1"), "latin-1", "utf-8") == lines[0]
    assert mojibake.damaged_lines(df.where("false")).count() == 0


def test_mojibake_of_a_whole_site_or_source(spark):
    text = "Το άγνωστο νερό άνοιξε τον λευκό συντονισμό στη μεγάλη πλατεία της πόλης όπου γράφει ο καιρός την ιστορία των ανθρώπων".split()
    other = "Водата в старата къща беше студена и всички хора от града отидоха при голямата река".split()
    said = lambda i, ws: " ".join(random.Random(i).sample(ws, len(ws)))
    bad = lambda t: "".join(bytes([b]).decode("latin-1") for b in t.encode())
    site = [(i, "foreign" if i % 10 == 0 else "hot" if i % 10 < 3 else f"s{i % 41}", f"x{i % 7}") for i in range(1, 401)]
    for hot in (lambda d, s: d == "hot", lambda d, s: s == "z"):
        rows, want = [], set()
        for i, d, s in site:
            s = "z" if i % 3 == 0 and d != "foreign" else s
            t = said(i, other if d == "foreign" else text)
            if d != "foreign" and hot(d, s):
                want.add(i)
                t = bad(t)
            rows.append((i, t, d, s))
        df = spark.createDataFrame(rows, "doc_id bigint, text string, url_host_registered_domain string, source string")
        assert {r.doc_id for r in mojibake.damaged_lines(df).collect()} == want


def test_leakage_against_brute_force(spark, rows):
    r = random.Random(4)
    items = [" ".join(r.choice("abcdef") + r.choice("xyz") for _ in range(r.randrange(5, 30))) for _ in range(8)]
    texts = []
    for _ in range(30):
        it = r.choice(items).split()
        a = r.randrange(len(it))
        texts.append(greek(r.random(), 5) + " " + ",\n".join(it[a : a + r.randrange(8, 20)]).upper() + " " + greek(r.random(), 3))
    docs, bench = frame(spark, texts + EDGE), spark.createDataFrame([*enumerate(items), (99, None), (98, "")], "item_id bigint, text string")
    want = set()
    for i, t in enumerate(texts, 1):
        ws = words(t)
        for k, it in enumerate(items):
            iw = words(it)
            grams = {tuple(iw[j : j + 12]) for j in range(len(iw) - 11)}
            if any(tuple(ws[j : j + 12]) in grams for j in range(len(ws) - 11)):
                want.add((i, k))
    assert want and set(rows(leakage.found(docs, bench))) == want
    joined = {(x.doc_id, x.item_id) for x in leakage.scan(docs, bench, block_windows=1).collect()}
    assert joined == want
    one, many = ({tuple(x) for x in leakage.scan(docs, bench, block_windows=k).collect()} for k in (10**6, 20))
    assert one == many and leakage.scan(docs, bench.where("false")).count() == 0
    cleaned = leakage.decontaminated(docs, bench)
    assert leakage.found(cleaned, bench).count() == 0 and cleaned.count() == docs.count()


def test_mixing(spark):
    r = random.Random(5)
    sizes = spark.createDataFrame([(i, "a" if i < 900 else "b", r.randrange(1, 50)) for i in range(1000)] + [(5000, None, 9)], "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("A ", 0.5, 1), ("b", 0.4, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeat int")
    rate = mixing.rates(sizes, targets)
    exact = int(rate.first().exact_total)
    rate = mixing.rates(sizes, targets, exact)
    mixed = mixing.mix(sizes, rate, rows_per_bucket=50)
    got = {x.source: x for x in mixing.shares(mixed, rate).collect()}
    assert got["b"].most_copies <= 3 and got["a"].most_copies == 1 and got["none"].mix_tokens == 0
    assert abs(got["a"].actual_share - 5 / 9) < 0.03
    per = {(x.source, x.n) for x in mixed.groupBy("source", "doc_id").count().select("source", F.col("count").alias("n")).collect()}
    c = {x.source: x.rate for x in rate.collect()}
    assert all(int(c[s]) <= n <= int(c[s]) + 1 for s, n in per)
    assert mixing.mix(sizes.where("false"), mixing.rates(sizes.where("false"), targets)).count() == 0


def test_default_mix_meets_the_shares(spark):
    sizes = spark.createDataFrame([(i, "a" if i < 900 else "b", 20) for i in range(1000)], "doc_id bigint, source string, n_tokens bigint")
    targets = spark.createDataFrame([("a", 0.5, 3), ("b", 0.5, 2)], "source string, target_share double, max_repeat int")
    rate = mixing.rates(sizes, targets)
    got = {x.source: x for x in mixing.shares(mixing.mix(sizes, rate, rows_per_bucket=50), rate).collect()}
    assert abs(got["a"].actual_share - 0.5) < 0.01 and got["b"].most_copies == 2
    scarce = spark.createDataFrame([("a", 0.5, 3), ("b", 0.5, 90)], "source string, target_share double, max_repeat int")
    assert mixing.mix(sizes, mixing.rates(sizes, scarce)).agg(F.sum("n_tokens")).first()[0] == pytest.approx(20_000, rel=0.01)


def test_reading(spark):
    easy, hard = "Η γάτα παίζει. Το παιδί γελά. " * 5, "Η συνταγματική διεπιστημονικότητα των θεσμών υποδηλώνει την αναδιάρθρωση μιας ευρύτερης διακυβέρνησης εντός του κανονιστικού πλαισίου. " * 3
    df = frame(spark, [easy, hard, *EDGE] + [easy] * 5)
    labels = spark.createDataFrame([], "doc_id bigint, rater string, quality int, reading_grade int")
    got = {r.doc_id: r.level for r in reading.levels(df, labels, 20).collect()}
    assert got[2] > got[1] and got[3] is None and got[4] is None and len(got) == 11


def test_marks_are_held_out(spark):
    r = random.Random(3)
    rows = [(i, 9, 1, r.random(), 2.0 ** r.uniform(1, 5)) for i in range(200)]
    measured = spark.createDataFrame(rows, reading.FIGURES)
    import math

    marks = [(i, "a", 3, round(1 + 4 * u + 2 * math.log(w))) for i, _, _, u, w in rows]
    labels = spark.createDataFrame([*marks, (0, "b", 3, None), (999, "b", 3, 4)], "doc_id bigint, rater string, quality int, reading_grade int")
    got = reading.held_out(measured, labels).first()
    assert got.n_marks == 200 and got.correlation > 0.97 and got.mean_error < 0.5
    none = reading.held_out(measured, labels.where("false")).first()
    assert (none.n_marks, none.correlation) == (0, None)


def test_quality_labels(spark):
    rows = [f"στοιχείο {i};{i * 7};{i},50;ΝΑΙ" for i in range(12)]
    prose = "Το παιδί παίζει στην αυλή και η γάτα κοιμάται στο σπίτι. Ο καιρός είναι καλός."
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    got = {r.doc_id: r for r in quality.statistics(frame(spark, ["\n".join(rows), prose, "\n".join([prose] * 4 + rows[:1]), *EDGE]), pages).collect()}
    assert got[1].table_share > 0.9 and got[2].prose_share == 1 and got[3].prose_share > 0.5 and got[4].n_words == 0


def test_boilerplate(spark, rows):
    docs = [f"Αρχική | Υγεία | Χάρτης | Νέα\n{greek(i, 9)} και το παιδί.\nΔημοφιλή\nΗ {greek(i + 50, 6)}" for i in range(12)]
    pages = spark.createDataFrame([(1, "u1", "<body><nav><a>Αρχική | Υγεία | Χάρτης | Νέα</a></nav><p>x</p></body>"), (2, None, None)], "page_id bigint, url string, html string")
    got = rows(boilerplate.found(frame(spark, docs + EDGE), pages))
    assert got == sorted((i, k) for i in range(1, 13) for k in (1, 3, 4))
    many = rows(boilerplate.found(frame(spark, docs + EDGE), pages.where("false")))
    assert many == got


def test_element_trees_and_their_hashes():
    nodes = boilerplate.tree("<div class=a>t<nav><a>x</a><p>y</nav>u</div></ul>z")
    assert [(n.tag, n.parent, n.leaves) for n in nodes] == [("", -1, [("z", False)]), ("div", 0, [("t", False), ("u", False)]), ("nav", 1, [("x", False), ("y", True)])]
    key = str.upper
    base = boilerplate.subtree_hashes(boilerplate.tree("<div><nav><a>x</a></nav></div>"), key)
    deep = boilerplate.subtree_hashes(boilerplate.tree("<div><nav><a>w</a></nav></div>"), key)
    moved = boilerplate.subtree_hashes(boilerplate.tree("<p>q</p><div><nav><a>X</a></nav></div>"), key)
    assert base[1] != deep[1] and base[1:] == moved[1:] and base[0] != moved[0]


def test_recurring_subtrees_go_with_all_below_them():
    """Lines that recur nowhere as lines go because an element above them recurs."""
    root, box, inner = (-1, None, 0, False, False), (-2, None, 2 * 1 + 1, False, True), (-3, None, 2 * 2 + 1, False, False)
    leaves = [(-3, 10, boilerplate.LETTERS | boilerplate.PROSE, False, False), (-1, 11, boilerplate.LETTERS | boilerplate.PROSE, False, False)]
    lines = [(1, 10, boilerplate.LETTERS | boilerplate.PROSE, False, False), (2, 11, boilerplate.LETTERS | boilerplate.PROSE, False, False)]
    assert boilerplate.decide([root, box, inner, *leaves, *lines]) == [1]
    assert boilerplate.decide([root, (-2, None, 2, False, True), inner, *leaves, *lines]) == []  # an element of the page's own content
    assert boilerplate.decide(lines) == []


def test_recurring_subtrees_are_counted_by_site(spark, rows):
    page = lambda k: f"<main><p>{greek(k, 9)} και το σπίτι.</p></main><div class=r><section><p>Ένα που μένει εδώ πάντα.</p><p>Άλλο που μένει εκεί πάντα.</p></section></div>"
    texts = [f"{greek(k, 9)} και το σπίτι.\nΈνα που μένει εδώ πάντα.\nΆλλο που μένει εκεί πάντα." for k in range(9)]
    docs = frame(spark, texts)
    pages = spark.createDataFrame([(k, f"u{k + 1}", page(k)) for k in range(9)], "page_id bigint, url string, html string")
    e = boilerplate.page_elements(pages, docs)
    local, _ = boilerplate.templates(e, boilerplate.site_sizes(docs))
    assert {r.n for r in local.collect()} == {9} and local.count() == 2  # the div and its section, not the root or main
    assert rows(boilerplate.found(docs, pages)) == [(i, k) for i in range(1, 10) for k in (2, 3)]
    small, large = (rows(boilerplate.flags(boilerplate.line_elements(docs), boilerplate.site_sizes(docs), most), "doc_id", "line_no", "hit", "hit_top") for most in (0, 10**6))
    assert small == large


def test_language_network_on_held_out_lines(spark):
    r = random.Random(2)
    lists = {"ell": "το και η του την στο είναι που με για παιδί νερό σπίτι", "eng": "the and of to which when they water house often there were", "bul": "и са не на в през които вода къща когато всички има"}
    data = [(k, " ".join(r.choice(v.split()) for _ in range(14))) for k, v in lists.items() for _ in range(160)]
    r.shuffle(data)
    docs = spark.createDataFrame([(i, t, "f", i) for i, (_, t) in enumerate(data)], "doc_id bigint, text string, warc_filename string, warc_record_offset bigint")
    manifest = spark.createDataFrame([(k, "f", i) for i, (k, _) in enumerate(data[:360])], "content_languages string, warc_filename string, warc_record_offset bigint")
    x, y = language.examples(language.labelled_windows(docs, manifest))
    assert len(y) >= 360
    net = language.Network.loaded(language.train(x, y).saved()).prepared()
    hits = sum(language.CODES[int(net(language.windows(t)).mean(0).argmax())] == k for k, t in data[360:])
    assert hits >= 0.95 * len(data[360:])
    assert language.windows("α" * 500).shape == (8, language.WINDOW) and language.windows("").shape == (1, language.WINDOW)


def test_language_edges(spark):
    docs, manifest = frame(spark, EDGE), spark.createDataFrame([], "content_languages string, warc_filename string, warc_record_offset bigint")
    with pytest.warns(UserWarning):
        assert language.fitted(docs, manifest) is None
    assert language.unlisted(docs, manifest, None).count() == 0
    got = language.labelled_lines(frame(spark, [greek(1, 40)]), None).first()
    assert (got.lang_code, got.confidence) == ("none", 0.0)


def test_language_sample_is_the_least_hashes_of_all_rows(spark):
    """The sample's size does not depend on how many rows there are, and no rows are out of reach."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("το νερό και η γάτα στην αυλή του σπιτιού "), F.col("id").cast("string")).alias("text"), F.lit("f").alias("warc_filename"), F.col("id").alias("warc_record_offset"))
    manifest = docs.select(F.lit("ell").alias("content_languages"), "warc_filename", "warc_record_offset")
    few = {bytes(r.window) for r in language.labelled_windows(docs, manifest, 50).collect()}
    assert len(few) == 50
    more = {bytes(r.window) for r in language.labelled_windows(docs.where("doc_id % 3 = 0"), manifest, 1000).collect()}
    assert len(more) == 1000
    assert len(language.examples(language.labelled_windows(docs, manifest, 50), {"greek": 7, "other": 1, "cyrillic": 1, "none": 1})[1]) == 7


def plain_posterior(model, symbols):
    """Forward-backward of one sequence, step by step."""
    e = model.emit[:, symbols].T
    f, b = [model.start * e[0]], [np.ones(4)]
    for x in e[1:]:
        f.append((f[-1] @ model.move) * x)
    for x in e[:0:-1]:
        b.insert(0, model.move @ (x * b[0]))
    g = np.array(f) * np.array(b)
    whole = f[-1].sum()
    pair = sum((np.outer(f[t], e[t + 1] * b[t + 1]) * model.move / whole for t in range(len(e) - 1)), np.zeros((4, 4)))
    return g / g.sum(1, keepdims=True), pair


def test_posteriors_of_many_sequences_are_those_of_each():
    r = random.Random(8)
    model = quality.Model()
    seqs = [[r.randrange(256) for _ in range(r.choice([1, 2, 3, 9, 40]))] for _ in range(60)] + [[]]
    got, pair = model.posteriors(seqs)
    want = [plain_posterior(model, s) for s in seqs if s]
    for a, (b, _) in zip(got, want, strict=False):
        assert np.allclose(a, b)
    assert np.allclose(pair, sum(p for _, p in want)) and got[-1].shape == (0, 4)
    counts = model.expected(seqs)
    assert counts[:1024].sum() == pytest.approx(sum(map(len, seqs)))


def test_model_is_fitted_over_all_documents(spark):
    r = random.Random(8)
    seqs = [[r.choice([131, 131, 3, 64, 20]) for _ in range(r.randrange(1, 12))] for _ in range(200)]
    df = spark.createDataFrame([(s,) for s in seqs] + [([],)], "symbols array<smallint>").repartition(3)
    a, b = quality.fitted(df), quality.Model().fit(seqs)
    assert np.allclose(a.emit, b.emit) and np.allclose(a.move, b.move) and np.allclose(a.start, b.start)
    tenfold = quality.Model().fit(seqs * 10)
    assert np.allclose(tenfold.emit, b.emit)  # the same corpus ten times gives the same model


NULLS = "doc_id bigint, text string, url string, url_host_registered_domain string, source string, warc_filename string, warc_record_offset bigint, lang string"


def everything(spark, docs):
    """Every operator over some documents, with side tables that hold nulls as well: name -> rows."""
    pages = spark.createDataFrame([(1, "u1", "<p>x</p>"), (None, None, None), (2, "u2", None), (3, "u3", "")], "page_id bigint, url string, html string")
    manifest = spark.createDataFrame([("ell", "f", 1), (None, None, None), ("", "f", 2), (None, "f", 3)], "content_languages string, warc_filename string, warc_record_offset bigint")
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k l m"), (None, "a b"), (2, None), (1, "a b c d e f g h i j k l m")], "item_id bigint, text string")
    targets = spark.createDataFrame([("news", 0.5, 2), (None, 0.3, 1), ("x", None, 1), ("blog", 0.2, None)], "source string, target_share double, max_repeat int")
    labels = spark.createDataFrame([(1, None, None, 3), (None, "a", 1, 2), (2, "a", None, None)], "doc_id bigint, rater string, quality int, reading_grade int")
    network = language.Network()
    sizes = mixing.token_counts(docs)
    rate = mixing.rates(sizes, targets)
    measured = reading.figures(docs, ["και"])
    language.fitted(docs, manifest)
    frames = {
        "found": pii.found(docs), "redacted": pii.redacted(docs), "lines": language.labelled_lines(docs, network), "unlisted": language.unlisted(docs, manifest, network),
        "measure": repetition.measure(docs), "few": repetition.measure(docs, every=False), "bands": repetition.bands(docs), "site": site_lines.found(docs), "report": site_lines.report(docs, min_share=0.1), "cleaned": site_lines.cleaned(docs),
        "furniture": boilerplate.found(docs, pages), "body": boilerplate.body(docs, pages), "statistics": quality.statistics(docs, pages), "damaged": mojibake.damaged_lines(docs), "restored": mojibake.restored(docs),
        "leaks": leakage.scan(docs, bench), "clean": leakage.decontaminated(docs, bench), "mix": mixing.mix(sizes, rate), "shares": mixing.shares(mixing.mix(sizes, rate), rate), "levels": reading.levels(docs, labels, 5), "fit": reading.held_out(measured, labels),
    }
    return {k: f.collect() for k, f in frames.items()}


def test_nulls_in_any_column_empty_tables_and_repeated_rows(spark):
    rows = [(1, "α β γ. a b c d e f g h i j k l m", "u1", "s", "news", "f", 1, "l"), (None, "κείμενο χωρίς αριθμό και με γραμμή\n" * 3, "u2", "s", "news", "f", 2, "l"), (2, None, None, None, None, None, None, None), (3, "γραμμή κειμένου που μένει", None, None, None, None, None, None), (4, "", "u3", "", "", "", 0, "")]
    docs = spark.createDataFrame(rows, NULLS)
    got = everything(spark, docs)
    for per_document in ("redacted", "measure", "few", "bands", "cleaned", "body", "restored", "clean"):
        assert len(got[per_document]) == 5, per_document
    assert {(r.doc_id, r.item_id) for r in got["leaks"]} == {(1, 1)}
    twice = everything(spark, docs.union(docs))
    assert len(twice["redacted"]) == 10 and {tuple(r) for r in twice["leaks"]} == {tuple(r) for r in got["leaks"]}
    none = everything(spark, docs.where("false"))
    assert not any(none[k] for k in none if k not in ("shares", "fit"))
    assert {r.mix_tokens for r in none["shares"]} == {0} and none["fit"][0].n_marks == 0
