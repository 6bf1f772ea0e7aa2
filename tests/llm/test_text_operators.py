"""Operators on documents against brute force, with odd rows: nulls, empty, long, repeated, clashing columns."""

import hashlib
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from trolley.llm import attribution, decontamination, langid, licenses, near_dup, packing, pii, toxicity
from trolley.llm.tokens import default_vocabulary, encoder

SF = "/root/testdata/sf0.001"
LONG = "palavra longa " * 30_000
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "a"),
    (4, "a"),
    (None, "sem id nenhum aqui dentro"),
    (5, LONG),
    (6, "Ação — 🙂 éà<|endoftext|>\n\nfim"),
    (7, "!!! ???"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumns(
        {"_row": F.lit(1), "node": F.lit("x"), "part": F.lit(2), "size": F.lit(3), "n_chars": F.length("text").cast("long")}
    )


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts():
    return duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(default_vocabulary())
    t.encode_special_tokens = True
    return t


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def test_ids_equal_the_tokenizers_library(tokenizer, texts):
    encode, sizes = encoder(default_vocabulary())
    for text in [t for _, t in texts] + [t or "" for _, t in ODD[:-4]] + ["🙂é x  \n y"]:
        ids = encode(text)
        assert ids == ids_of(tokenizer, text)
        assert sizes[np.array(ids, dtype=np.int64)].sum() == len(text.encode())


def test_attribution_adds_up_and_equals_offsets(spark, docs, texts, tokenizer):
    rows = attribution.attribute_tokens(docs).toPandas()
    totals = rows.groupby("doc_id")["n_tokens"].sum()
    assert all(totals[i] == len(ids_of(tokenizer, t)) for i, t in texts)
    i, text = texts[3]
    found = tokenizer.encode(text, add_special_tokens=False)
    own = rows[rows.doc_id == i].sort_values("section")
    assert "".join(text[a:b] for a, b in zip(own["start"], own["end"], strict=True)) == text
    if text.isascii():
        starts = [a for a, _ in found.offsets]
        got = np.histogram(starts, bins=[*own["start"], len(text) + 1])[0]
        assert abs(got - own["n_tokens"].to_numpy()).sum() <= 2 * own["n_crossing"].sum()


def test_boundary_tokens_go_to_the_larger_part():
    tokens, crossing = attribution.count_spans(np.array([3, 4, 1]), np.array([0, 5, 8]))
    assert tokens.tolist() == [2, 1] and crossing.tolist() == [1, 0]  # 3..7 holds two bytes of each: the earlier one
    tokens, _ = attribution.count_spans(np.array([3, 4, 1]), np.array([0, 4, 8]))
    assert tokens.tolist() == [1, 2]


def test_attribution_of_odd_rows_and_given_sections(spark, odd):
    rows = attribution.attribute_tokens(odd).toPandas()
    assert rows[rows.doc_id == 1].n_tokens.tolist() == [0]
    assert len(rows[rows.doc_id == 4]) == 2
    sections = spark.createDataFrame([(5, 7), (5, 10**9), (5, -1)], "doc_id long, end long")
    own = attribution.attribute_tokens(attribution.section_intervals(odd, sections), cuts="cuts").filter("doc_id = 5").toPandas()
    assert sorted(zip(own.start, own.end, strict=True)) == [(0, 7), (7, len(LONG))]
    assert attribution.attribute_tokens(odd.limit(0)).count() == 0


def test_packing_holds_every_token_once(docs, odd, texts, tokenizer):
    for df, rows in ((docs, texts), (odd.filter("doc_id is not null").dropDuplicates(["doc_id"]), None)):
        rows = rows or [(i, t) for i, t in dict(x for x in ODD if x[0] is not None).items()]
        got = packing.pack_pieces(packing.written(packing.token_pieces(df), "p"), part_rows=40).toPandas()
        pieces = {k: v.sort_values("piece") for k, v in got.groupby("doc_id")}
        for i, text in rows:
            ids = np.array([*ids_of(tokenizer, text), 0], dtype="<u4")
            own = pieces[i]
            assert own["length"].sum() == len(ids) and (own["length"].iloc[1:] == 2048).all()
            for p in own.itertuples():
                assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
        for _, s in got.sort_values("offset").groupby("sequence_id"):
            assert s["offset"].tolist() == [0, *s["length"].cumsum().tolist()[:-1]] and s["length"].sum() <= 2048
    assert packing.pack_documents(odd.limit(0)).count() == 0


def test_bounds_hold_and_rounds_add_no_sequence(spark):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 2048, 3000)
    _, offset, bins = packing.best_fit_decreasing(lengths, 2048)
    assert packing.lower_bound(lengths, 2048) <= bins <= packing.lower_bound(lengths, 2048) * 1.03
    assert packing.lower_bound([1025] * 7, 2048) == 7 and packing.lower_bound([], 2048) == 0
    assert packing.lower_bound([700] * 6, 2048) == 3
    rows = [(i, 0, 0, int(n), i) for i, n in enumerate(lengths)]
    pieces = packing.written(spark.createDataFrame(rows, packing.PIECES), "pieces")
    count = lambda r: packing.pack_pieces(pieces, part_rows=100, rounds=r).select("sequence_id").distinct().count()
    assert bins - 1 <= count(2) <= count(0)


def test_near_duplicates_equal_brute_force(docs, texts):
    sets = {i: set(near_dup.shingles(t)[0].tolist()) for i, t in texts}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_text = {}
    ids = sorted(sets)
    for n, a in enumerate(ids):
        by_text.setdefault(dict(texts)[a], []).append(a)
        for b in ids[:n]:
            common = len(sets[a] & sets[b])
            if common and common >= 0.8 * (len(sets[a]) + len(sets[b]) - common):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    for same in by_text.values():
        for b in same[1:]:
            parent[max(root(same[0]), root(b))] = min(root(same[0]), root(b))
    got = {r["doc_id"]: r["class_id"] for r in near_dup.duplicate_classes(docs).collect()}
    assert got == {i: root(i) for i in ids}


def test_near_duplicates_of_odd_rows(spark, odd):
    rows = near_dup.duplicate_classes(odd).collect()
    assert len(rows) == len(ODD)
    classes = Counter((r["doc_id"], r["class_id"]) for r in rows)
    assert classes[(4, 4)] == 2 and classes[(1, 1)] == classes[(2, 2)] == 1 and classes[(None, None)] == 1
    kept = near_dup.deduplicate(odd)
    assert kept.columns == odd.columns and kept.count() == len(ODD) - 1
    assert near_dup.duplicate_classes(odd.limit(0)).count() == 0


def test_large_group_of_near_copies_is_one_class(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(words))]
    for i in range(1, 150):
        own = list(words)
        for at in rng.integers(0, 400, 4):
            own[at] = f"x{i}"
        rows.append((i, " ".join(own)))
    rows.append((900, " ".join(f"other{i}" for i in range(400))))
    got = {r["doc_id"]: r["class_id"] for r in near_dup.duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: 0 for i in range(150)} | {900: 900}


def test_near_copies_that_repeat_a_line_are_found(spark):
    rows = []
    for i in range(100):
        body, line = " ".join(f"b{i}x{k}" for k in range(40)), " ".join(f"l{i}x{k}" for k in range(16))
        rows += [(2 * i, f"{body} {line}"), (2 * i + 1, f"{body} {' '.join([line] * 40)}")]
    sets = [set(near_dup.shingles(t)[0].tolist()) for _, t in rows]
    assert all(len(a & b) >= 0.9 * len(a | b) for a, b in zip(sets[::2], sets[1::2], strict=True))
    got = near_dup.duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: i - i % 2 for i in range(200)}


@pytest.mark.parametrize(("shared", "other", "least"), [(172, 14, 0.83), (168, 18, 0.8)])
def test_recall_where_a_passage_is_repeated_sixty_times(spark, shared, other, least):
    """One text holds the passage once, the other sixty times; each has words of its own as well."""
    rows = []
    for i in range(60):
        body, line = [f"b{i}x{k}" for k in range(shared - 40)], [f"l{i}x{k}" for k in range(40)]
        own = [[f"{c}{i}x{k}" for k in range(other)] for c in "yz"]
        rows += [(2 * i, " ".join(body + line + own[0])), (2 * i + 1, " ".join(body + line * 60 + own[1]))]
    sets = [set(near_dup.shingles(t)[0].tolist()) for _, t in rows]
    alike = [least <= len(a & b) / len(a | b) < least + 0.03 for a, b in zip(sets[::2], sets[1::2], strict=True)]
    assert np.mean(alike) == 1
    got = near_dup.duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = {r["doc_id"]: r["class_id"] for r in got}
    assert np.mean([found[2 * i + 1] == 2 * i for i in range(60)]) >= 0.98


def test_cuts_keep_short_texts_that_are_alike(spark):
    rng, rows = np.random.default_rng(6), []
    for i in range(3000):
        elements = np.sort(rng.integers(0, 2**63, 5, dtype=np.uint64))
        for node, x in ((2 * i, elements), (2 * i + 1, elements[:4])):
            fine = near_dup.sketch(near_dup.prob_min_hash(x, np.ones(len(x)), near_dup.FINE_REGISTERS))
            rows.append((node, len(x), *fine.tolist()))
    planes = near_dup.FINE
    sketches = spark.createDataFrame(rows, "node long, size int, " + ", ".join(f"{c} long" for c in planes))
    members = sketches.selectExpr("node div 2 as key", "node", "node as component", "2L as n").filter("node % 2 = 0")
    led = sketches.selectExpr("node div 2 as key", "node as leader", "-node as own", "2L as n").filter("leader % 2 = 1")
    met = near_dup._candidates(members, led, sketches, near_dup.FINE_APART)
    assert met.count() >= 2998


def _joined_rows(df):
    """Rows of the join in which members meet leaders, as Spark's metrics count them."""
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if "m_key" in node.simpleString(99) and "Join" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    assert len(found) == 1
    return found[0]


def test_copies_that_share_many_buckets_meet_once(spark):
    """Five leaders and sixty members in twenty buckets, of which some lack a leader or a member: no pair twice, none lost."""
    fine = near_dup.sketch(near_dup.prob_min_hash(near_dup.mix(np.arange(300, dtype=np.uint64)), np.ones(300)))
    sketches = spark.createDataFrame([(i, 300, *fine.tolist()) for i in range(65)], "node long, size int, " + ", ".join(f"{c} long" for c in near_dup.SKETCH))
    members = [(key, node, node, 65) for key in range(20) for node in range(65) if (node + key) % 7]
    led = [(key, leader, leader, 65) for key in range(20) for leader in range(60, 65) if (leader + key) % 7 and (leader + key) % 3]
    share = {(b, a) for k, a, *_ in members for x, b, *_ in led if k == x and a != b}
    members = spark.createDataFrame(members, "key long, node long, component long, n long")
    led = spark.createDataFrame(led, "key long, leader long, own long, n long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        met = near_dup._candidates(members, led, sketches, near_dup.MOST_APART)
        pairs = {(r["a"], r["b"]) for r in met.collect()}
        joined = _joined_rows(met)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert pairs == {(max(x), min(x)) for x in share}
    assert joined == len(share)


def test_unlike_texts_of_one_bucket_are_all_compared(spark):
    """A passage that many unlike texts share: the few near copies among them are found, the others left alone."""
    passage = " ".join(f"p{k}" for k in range(120))
    rows = [(i, passage + " " + " ".join(f"o{i}x{k}" for k in range(60))) for i in range(300)]
    rows += [(1000 + i, rows[i][1] + f" tail{i}") for i in range(0, 300, 10)]
    got = near_dup.duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: i % 1000 for i, _ in rows}


def test_prob_min_hash_estimates_probability_jaccard():
    rng = np.random.default_rng(4)
    elements = near_dup.mix(np.arange(300, dtype=np.uint64))
    x, y = rng.uniform(0.5, 3, 300), rng.uniform(0.5, 3, 300)
    x[200:], y[:80] = 0, 0
    truth = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in range(300) if x[i] and y[i])
    a = near_dup.prob_min_hash(elements[x > 0], x[x > 0], 4000)
    b = near_dup.prob_min_hash(elements[y > 0], y[y > 0], 4000)
    assert (a == b).mean() == pytest.approx(truth, abs=0.03)


def test_decontamination_equals_regular_windows(spark, docs, texts):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = duckdb.connect().execute(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    fold = lambda t: word.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = {}
    for i, t in items:
        w = fold(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k : k + 10]), set()).add(str(i))
    got = {r["doc_id"]: r for r in decontamination.contamination_report(docs, bench).collect()}
    for i, t in texts:
        w, hit, found = fold(t), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if (own := windows.get(tuple(w[k : k + size]))) is not None:
                    hit |= set(range(k, k + size))
                    found |= own
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (len(w), len(hit), len(found))
        assert r["items_sha256"] == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
    # Shards give the same rows, spans lie in the original text, clean documents stay.
    shards = decontamination.find_contamination(docs, bench, max_chars=2000).toPandas()
    whole = decontamination.find_contamination(docs, bench).toPandas()
    key = lambda d: {r.doc_id: (list(r.hit), list(r["items"])) for _, r in d.iterrows()}
    assert key(shards) == key(whole)
    text = dict(texts)
    for _, r in whole[whole.hit.map(len) > 0].iterrows():
        words = [x for a, b in zip(r.spans[::2], r.spans[1::2], strict=True) for x in fold(text[r.doc_id][a:b])]
        assert len(words) == len(r.hit)
    kept = {r["doc_id"] for r in decontamination.decontaminate(docs, bench).collect()}
    assert kept == {i for i, r in got.items() if not r["contaminated"]}


def test_decontamination_of_odd_rows(spark, odd):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "sem id nenhum"), (None, "palavra longa"), (3, "A")], "item_id long, text string")
    rows = {r["doc_id"]: r for r in decontamination.contamination_report(odd, bench).collect()}
    assert rows[None]["n_hit"] == 3 and rows[5]["n_hit"] == 60_000 and rows[5]["n_items"] == 0
    assert rows[4]["contaminated"] and not rows[1]["contaminated"]
    assert decontamination.decontaminate(odd, bench).columns == odd.columns
    assert decontamination.decontaminate(odd, bench.limit(0)).count() == len(ODD)


def naive_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 16 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0])):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(digits(m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_spans_equal_the_plain_patterns(texts):
    rng = np.random.default_rng(6)
    made = ["".join(rng.choice(list("ab@@..--+19 05()"), 60)) for _ in range(3000)]
    for text in [t for _, t in texts] + made + ["a@b.c@d.e", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "+49 (0)151-2345678"]:
        assert pii.base_spans(text) == naive_spans(text)
    assert pii.base_spans("9" * 50_000 + "@" + "a" * 50_000) == []


def test_personal_data_operator(spark, docs, odd, texts):
    rows = {r["doc_id"]: r for r in pii.find_personal_data(docs).collect()}
    for i, text in texts:
        base = naive_spans(text)
        assert rows[i]["base_sha256"] == hashlib.sha256(pii.listed(base).encode()).hexdigest()
        assert {pii.listed([s]) for s in base} <= set(rows[i]["spans"].split(","))
    field = pii.train([])
    secret = 'x token = "a7898f631d0c339a0d2af2f50c7613fcfdcec734" y'
    base, spans = pii.all_spans(secret, field)
    assert base == [] and [secret[a:b] for k, a, b in spans if k == "secret"] == ["a7898f631d0c339a0d2af2f50c7613fcfdcec734"]
    assert pii.all_spans("am 12. Mai 2024 um 10 Uhr, 3,5 kg und 1.234", field)[1] == []
    assert pii.masked("to a@b.co now", [("email", 3, 9)]) == "to [EMAIL] now"
    out = pii.find_personal_data(odd, field)
    assert out.count() == len(ODD) and out.filter("spans <> ''").count() == 0
    masked = pii.mask_personal_data(odd, field)
    assert masked.columns == odd.columns and masked.filter("doc_id = 5").first()["n_chars"] == len(LONG)


def test_license_scan(spark, odd):
    mit = licenses.TEMPLATES["mit"]
    changed = mit.replace("deal in the Software", "deal with the Software")
    rows = spark.createDataFrame(
        [(1, "Released under the MIT License."), (2, f"é x\n{changed} tail"), (3, "Released under a MIT License"), (4, mit[:200]), (5, f"{mit} {mit}")],
        "doc_id long, text string",
    )
    got = {r["doc_id"]: r for r in licenses.scan_licenses(rows).collect()}
    assert got[1]["spans"] == "mit-line:0:30" and got[2]["licenses"] == "mit"
    assert got[3]["n_matches"] == got[4]["n_matches"] == 0 and got[5]["n_matches"] == 2
    name, start, end = got[2]["spans"].split(":")
    assert f"é x\n{changed} tail"[int(start) : int(end)] == changed.rstrip(".")
    assert licenses.scan_licenses(odd).filter("n_matches > 0").count() == 0
    # Retrieval finds every window that exact containment accepts.
    library = licenses.Library(licenses.TEMPLATES)
    for i, shingles in enumerate(library.sets):
        assert library.names[i] in {m[0] for m in library.matches("x y z " + licenses.TEMPLATES[library.names[i]] + " x y z")}
        assert len(shingles)


def test_languages_on_the_held_out_fold(spark, docs, odd):
    got = langid.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    fold = got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)
    assert (got["held_out"] == fold).all()
    assert (got[fold].lang == got[fold].lang_pred).mean() > 0.95
    rows = {r["doc_id"]: r for r in langid.identify_languages(odd.withColumn("lang", F.lit(None).cast("string"))).collect()}
    assert all(r["lang_pred"] == "und" for r in rows.values())
    one = langid.identify_languages(odd.withColumn("lang", F.lit("pt"))).collect()
    assert {r["lang_pred"] for r in one if r["doc_id"] in (1, 2, 3, 7)} == {"und"}
    for k in (2, 3, 5, 9):
        code = langid.codewords(k)
        assert len({tuple(r) for r in code}) == k and (abs(code.sum(axis=0)) < k).all()


def test_every_language_is_learnt_wherever_its_rows_lie(spark):
    langs = F.when(F.col("id") < 4700, "pt").when(F.col("id") < 4990, "en").when(F.col("id") < 4997, "fi")
    rows = spark.range(0, 5000, 1, 8).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("texto numero "), F.col("id")).alias("text"), langs.alias("lang")
    )
    got = langid.training_rows(rows, most=200)
    count = Counter(r["lang"] for r in got)
    kept = [i for i in range(4990, 4997) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert count == {"pt": 66, "en": 66, "fi": len(kept)} and kept
    moved = rows.orderBy(F.desc("doc_id")).repartition(3)
    assert langid.training_rows(moved.unionByName(rows.filter("doc_id % 3 = 0")), most=200) == got
    long_ = rows.withColumn("text", F.when(F.col("lang") == "fi", F.repeat("text", 2000)).otherwise(F.col("text")))
    assert "fi" in {r["lang"] for r in langid.training_rows(long_, most=200)}


def test_toxicity_gradients_are_right():
    rng = np.random.default_rng(0)
    net = toxicity.Network.fresh({b"a": 0}, rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    gates = rng.standard_normal((5, 3, 6 * toxicity.HIDDEN))
    mask = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], dtype=bool)
    target = np.array([1.0, 0.0, 1.0])

    def loss():
        logit = net.forward(gates, mask)
        return float((np.log1p(np.exp(logit)) - target * logit).sum() / 3)

    _, d_gates, g = net.gradients(gates, mask, target, np.ones(3))
    for array, grad in ((net.p["ahead"], g["ahead"]), (net.p["back"], g["back"]), (net.p["attend"], g["attend"]), (net.p["out"], g["out"]), (gates, d_gates)):
        at = tuple(rng.integers(0, n) for n in array.shape)
        old, step = array[at], 1e-3
        array[at] = old + step
        up = loss()
        array[at] = old - step
        down = loss()
        array[at] = old
        assert (up - down) / (2 * step) == pytest.approx(float(grad[at]), abs=2e-3)


def test_toxicity_learns_and_scores_odd_rows(spark, odd):
    rng = np.random.default_rng(8)
    words = [f"{a}{b}" for a in ("bo", "ca", "di", "fu", "ge") for b in ("la", "me", "no", "pi", "ru", "sa")]
    make = lambda bad: " ".join([*rng.choice(words, rng.integers(5, 120)), *(["zkrel" + str(rng.choice(words))] if bad else [])])
    texts, labels = zip(*[(make(i % 3 == 0), int(i % 3 == 0)) for i in range(180)], strict=True)
    net = toxicity.train(list(texts), list(labels), steps=150, batch=48)
    scores, windows = toxicity.Scorer(net).scores([make(True) for _ in range(20)] + [make(False) for _ in range(20)])
    right = [s >= 0.5 for s in scores[:20]] + [s < 0.5 for s in scores[20:]]
    assert np.mean(right) >= 0.9 and min(windows) >= 1
    rows = toxicity.score_toxicity(odd, net=net).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["doc_id"]: r["n_windows"] for r in rows}[1] == 0
    labels = spark.createDataFrame([(4, 1), (4, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(odd, labels).count() == len(ODD)
    assert toxicity.drop_toxic(odd, labels.limit(0)).columns == odd.columns


def test_windows_cover_every_word():
    lengths = np.array([0, 1, 48, 49, 72, 73, 1000])
    doc, start = toxicity.windows_of(lengths)
    for i, n in enumerate(lengths):
        own = start[doc == i]
        assert set(range(n)) <= {w for s in own for w in range(s, s + toxicity.WINDOW)}
