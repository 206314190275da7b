"""The operators on hand-made rows against plain forms of themselves, and the queries with SQL against it."""

import hashlib
import html
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from compare import difference, oracle_connection
from pulsebook.llm import components, darts, exact, mixing, neardup, packing, pii, suffix, tokencount, topk, toxicity, wrapper
from pulsebook.llm.common import identified
from pulsebook.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    assert difference(QUERIES[name](spark, FOLDER), oracle_connection(FOLDER), ORACLES[name]) is None


def test_exact(docs, nothing):
    rows = exact.groups(docs).collect()
    groups = defaultdict(list)
    for r in docs.collect():
        groups[re.sub(r"[\x20\x09-\x0D]", "", r.text or "")].append(r)
    assert len(rows) == docs.count() and sum(r.kept for r in rows) == len(groups)
    want = {hashlib.sha256(t.encode()).digest(): min(g, key=lambda r: (-len(r.text or ""), r.doc_id is None, r.doc_id or 0)).doc_id for t, g in groups.items()}
    assert all(want[bytes(r.digest)] == r.keep_key for r in rows)
    assert exact.groups(nothing).count() == 0


def test_cuts_are_local():
    data = random.Random(1).randbytes(200_000)
    a, b = exact.cut_points(data), exact.cut_points(b"new" + data)
    assert len(set(len(data) - x for x in a) & set(len(data) + 3 - x for x in b)) > 0.9 * len(a)
    assert a[-1] == len(data) and max(np.diff([0, *a])) <= exact.LARGEST


def test_best_fit_runs():
    rng = random.Random(2)
    for _ in range(100):
        room = rng.randint(2, 60)
        sizes = [rng.randint(1, room - 1) for _ in range(rng.randint(0, 200))]
        bins = []
        for s in sorted(sizes, reverse=True):
            fit = [b for b in range(len(bins)) if bins[b] >= s]
            if fit:
                bins[min(fit, key=lambda b: bins[b])] -= s
            else:
                bins.append(room - s)
        assert packing.best_fit_runs(Counter(sizes), room)[1] == len(bins)


def test_packing(docs, nothing):
    rows = packing.pack(docs).collect()
    encode = packing.encoder(*packing.public_files()).slow
    for r in rows[:50]:
        assert r.length <= packing.ROOM
    got, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r.key].append(r)
        bins[r.bin].append(r)
    for b in bins.values():
        ends = sorted((r.offset, r.offset + r.length) for r in b)
        assert ends[0][0] == 0 and all(x[1] == y[0] for x, y in zip(ends, ends[1:])) and ends[-1][1] <= packing.ROOM
    for d in docs.where("doc_id in (0, 3, 10)").collect():
        ids = np.array([*encode.encode(d.text or "", add_special_tokens=False).ids, 0], "<u4")
        mine = sorted(got[d.doc_id], key=lambda r: r.piece)
        assert [r.start for r in mine] == [sum(x.length for x in mine[:i]) for i in range(len(mine))]
        assert all(r.crc == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) for r in mine) and sum(r.length for r in mine) == len(ids)
    assert packing.pack(nothing).count() == 0


def similarity(a, b):
    def runs(t):
        w = (t or "").lower().split()
        return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])
    x, y = runs(a), runs(b)
    return sum((x & y).values()) / sum((x | y).values()) if x or y else 1.0


def test_near_duplicates(docs, nothing):
    rows, texts = neardup.near_duplicates(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()]
    assert len(rows) == len(texts) and sum(r.kept for r in rows) == len({r.class_key for r in rows})
    of = {r.key: r.class_key for r in rows}
    for i, a in texts:
        for j, b in texts:
            if similarity(a, b) >= 0.8:
                assert of[i] == of[j]
    assert of[8] == 8 and of[7] == of[4]
    assert neardup.near_duplicates(nothing).count() == 0


def test_dart_signatures_agree_as_often_as_sets():
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[:300] + ["x"] * 100), " ".join(words[40:] * 2)]
    e, c, of = darts.multisets(texts)
    ids = darts.signatures(e, c, of, 3, 2000)
    for i, j in ((0, 1), (0, 2), (1, 2)):
        assert abs((ids[i] == ids[j]).mean() - similarity(texts[i], texts[j])) < 0.05


def test_forest_links_what_the_hub_does_not_show(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40) if i % 10], "u long, v long")
    found = {r.node: r.root for r in components.components(links).collect()}
    assert found == {i: (i - 1) // 10 * 10 + 1 for i in range(1, 41) if i % 10 != 1}


def test_passages(docs, nothing, monkeypatch):
    monkeypatch.setattr(suffix, "BATCH_BYTES", 4000)
    rows = docs.select("doc_id", "text").collect()
    first = {}
    for r in rows:
        if r.doc_id is not None:
            b = (r.text or "").encode()
            for i in range(len(b) - 49):
                first[b[i : i + 50]] = min(first.get(b[i : i + 50], r.doc_id), r.doc_id)
    want = []
    for r in rows:
        b = (r.text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if r.doc_id is not None and first[b[i : i + 50]] < r.doc_id:
                gone[i : i + 50] = True
        spans = int(np.diff(gone.astype(int), prepend=0).clip(0).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        want.append((r.doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    got = [(r.key, r.n_bytes, r.n_removed, r.n_spans, r.digest, bytes(r.kept)) for r in suffix.earlier_passages(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert suffix.earlier_passages(nothing).count() == 0


def test_pii(docs, nothing):
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    spark = docs.sparkSession
    odd = ["a@b.c_d@e.f @x.y q@r", "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.1.1 é 9.9.9.9", "+1 +1-2 +12345678 +1234567890123456", "4111-1111-1111-1111 4111111111111112 " + "9 " * 30]
    frame = spark.createDataFrame([(r.doc_id, r.text) for r in docs.collect()] + [(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    rows, spans = pii.detect(frame)
    got = Counter((r.key, r.kind, r.start, r.end) for r in rows.join(spans, "row").collect() if r.kind != "term")
    want = Counter()
    for r in frame.collect():
        for kind, pattern in plain.items():
            for m in re.finditer(pattern, r.text or ""):
                d = re.sub("[^0-9]", "", m[0])
                luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
                if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 16 <= len(d) <= 19 and luhn, "phone": 8 <= len(d) <= 15}[kind]:
                    want[r.doc_id, kind, m.start(), m.end()] += 1
    assert got == want
    assert pii.detect(nothing)[1].count() == 0


def test_terms_that_disclose(spark):
    texts = [f"note{i} written by Zebulon at zeb@mail.example.com about weather {i}" for i in range(4)] + ["weather about written note by others at home"] * 3
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = [r.text for r in pii.sanitised(frame).orderBy("key").collect()]
    assert all("Zebulon" not in t and "[term]" in t and "[email]" in t and "weather" in t for t in out[:4]) and out[4:] == texts[4:]


@pytest.mark.parametrize("entity, other", [
    ("zeb@mail.example.com", "qu@mail.example.com"), ("+1 (132) 555-1352", "+1 (132) 555-1353"),
    ("10.0.0.255", "10.0.0.254"), ("4111 1111 1111 1111", "4000 0000 0000 0002"),
])
def test_terms_anywhere_in_the_document(spark, entity, other):
    texts = [f"Zebulon greets you{i}. " + "weather about written " * 20 + f"reach us{i}: {entity}. " + "others note " * 20 + "zebulon" for i in range(6)]
    # In one text it is a word of its own, once; the other name is seen in two texts only.
    texts += ["zebulon once", f"Quillon says this {other}", f"that Quillon says {other}"]
    texts += [f"weather about written others note greets reach says this that number{i}" for i in range(60)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = [r.text for r in pii.sanitised(frame).orderBy("key").collect()]
    assert all("ebulon" not in t and t.count("[term]") == 2 and "weather" in t for t in out[:6])
    assert out[6] == texts[6] and all("Quillon" not in t and "[term]" in t for t in out[7:9]) and out[9:] == texts[9:]


def test_mixing(docs, nothing):
    rows = mixing.mixed(docs, block_rows=2, cycle=10).collect()
    assert len(rows) == docs.count() == len({r.place for r in rows}) and mixing.mixed(nothing).count() == 0
    slots = mixing.shares({"a": 1, "b": 2.5, "c": 7}, 100)
    places = mixing.pfair(slots)
    for name, own in places.items():
        for t in range(101):
            assert abs(sum(p < t for p in own) - t * slots[name] / 100) < 1
    assert sorted(p for own in places.values() for p in own) == list(range(100))


def test_top_k(spark):
    rng = random.Random(3)
    vectors = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(1200)]
    vectors += [(50, [1.0] * 4), (None, [1.0] * 4), (2000, None), (2050, [1.0, None]), (2100, [float("inf")] * 4), (2150, [1e30] * 4)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    use = [(i, [int(256 * x // 1) for x in v]) for i, v in vectors if i is not None and v and None not in v and float("inf") not in v]
    want = []
    for n, (i, q) in enumerate(use):
        if i % 50 == 0:
            found = sorted((-sum(a * b for a, b in zip(q, v)), j) for m, (j, v) in enumerate(use) if m != n)[:5]
            want += [(i, k + 1, j, max(-(2**63), min(2**63 - 1, -s))) for k, (s, j) in enumerate(found)]
    assert sorted(map(tuple, topk.top_k(frame).collect())) == sorted(want)


def test_tokens(spark, tmp_path, docs):
    path = str(tmp_path / "documents.parquet")
    docs.repartition(3).write.parquet(path)
    frame = spark.read.parquet(path)
    encode = packing.encoder(*packing.public_files()).slow
    want = Counter((r.doc_id, len(encode.encode(r.text or "", add_special_tokens=False).ids)) for r in frame.collect())
    assert Counter(map(tuple, tokencount.counted(frame, file_rows=2).collect())) == want
    flat = str(tmp_path / "flat")
    tokencount.write_flat(frame, flat)
    assert sorted(r.n_tokens for r in tokencount.scan(spark, flat, block_bytes=64).collect()) == sorted(n for (_, n), k in want.items() for _ in range(k))


def test_pages(spark):
    page = '<html><head><title>t</title></head><body><nav><a>Home</a></nav><div class="cookie-bar">Ok?</div><article><h1>A &amp; {0}</h1><p>One<br>two <b>{0}<p>Share this<section class="comments"><p>Bad {0}</section></article><footer>f</footer>'
    rows = [(i, "http://h.example/x", page.format(i)) for i in range(6)] + [(6, None, None), (7, "", ""), (8, "http://x.example", "<p>plain &lt; text <p"), (0, "http://h.example/x", page.format(0))]
    out = [(r.key, r.text) for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()]
    want = [(i, f"A & {i}\nOne two {i}\nShare this") for i in (0, 0, 1, 2, 3, 4, 5)] + [(6, ""), (7, ""), (8, "plain < text")]
    assert sorted(out) == want


@pytest.mark.parametrize("attributes, kept", [
    ('style="overflow:hidden"', True), ('title="hidden gems"', True), ('data-id="nav-1"', True), ("data-role=navigation", True),
    ("data-hidden", True), ('title="class=menu"', True), ('aria-hidden="false"', True), ("alt='x' hidden", False), ('aria-hidden = "true"', False),
    ("role=navigation", False), ("ID='nav-1'", False), ('data-x="1" class="menu"', False),
])
def test_attributes_by_whole_name(attributes, kept):
    assert wrapper.main_text(f"<div {attributes}><p>Text</p></div>", None) == ("Text" if kept else "")


def test_pages_of_the_table(spark):
    rows = QUERIES["op2_wrapper_extraction"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/pages.parquet").drop("url"), "page_id").collect()
    for r in rows:
        body = re.search(r"<article>(.*?)(?:</article>|$)", r.html, re.S)[1]
        parts = (" ".join(html.unescape(re.sub(r"<[^>]+>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body))
        assert r.text == "\n".join(p for p in parts if p) and r.n_chars == len(r.text)


def test_toxicity(spark, docs, nothing):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(300)]
    texts = [" ".join(rng.choices(words, k=80)) + (" vilezorp" * 3 if i % 5 == 0 else "") for i in range(800)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(800)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    rows = toxicity.toxicity(frame, labels).collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.key).encode()) % 4 == 2) for r in rows)
    assert sum(r.predicted == (r.key % 5 == 0) for r in held) > 0.88 * len(held) > 100
    odd = toxicity.toxicity(docs, labels).collect()
    assert len(odd) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in odd)
    assert toxicity.toxicity(nothing, labels).count() == 0


def test_toxicity_tells_whole_strings_apart(spark):
    rng = random.Random(5)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 300)]
    texts = ["".join(rng.choices(letters[: 20 if i % 3 else 300], k=120)) for i in range(3000)]
    labels = {i: int(i % 7 == 0) for i in range(0, 3000, 2)}
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    model, _ = toxicity.fit(frame, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"))
    strings = lambda t: [f"\0{t}\0"[i : i + 5] for i in range(len(t) - 2)]
    corpus, shared = {s for t in texts for s in strings(t)}, defaultdict(lambda: 1 / 65536)
    for width in (2, 3, 4):
        ways = Counter(s[-width:] for s in corpus)
        total, kinds = Counter(), Counter(s[:-1] for s in ways)
        for s, n in ways.items():
            total[s[:-1]] += n
        shared |= {s: (n - 0.75 + 0.75 * kinds[s[:-1]] * shared[s[1:]]) / total[s[:-1]] for s, n in ways.items()}
    logs = []
    for mark in (1, 0):
        n = Counter(s for i, m in labels.items() if m == mark and zlib.crc32(str(i).encode()) % 4 != 2 for s in strings(texts[i]))
        total, kinds = Counter(), Counter(s[:-1] for s in n)
        for s, c in n.items():
            total[s[:-1]] += c
        logs.append(lambda s, n=n, total=total, kinds=kinds: np.log(
            max(n[s] - 0.75, 0) / max(total[s[:-1]], 1) + (0.75 * kinds[s[:-1]] / total[s[:-1]] if total[s[:-1]] else 1) * shared[s[1:]]
        ))
    want = []
    for t in texts[:200]:
        value = [logs[0](s) - logs[1](s) for s in strings(t)]
        over = sum(max(sum(value[i : i + 4]) - toxicity.MARGIN, 0) for i in range(len(value)))
        want.append(over / (len(value) + toxicity.SHORT_TEXT))
    assert len(corpus) > 50_000 and np.allclose(model.means(texts[:200]), want, rtol=1e-3, atol=1e-5)


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    kept = {r.doc_id for r in rows}
    plain = [re.sub(r"[\x20\x09-\x0D]", "", docs[d] or "") for d in kept]
    assert 0 < len(kept) < len(docs) and len(set(plain)) == len(plain)


def test_packing_keeps_the_mixture(spark, tmp_path):
    rng = random.Random(6)
    rows = [(i, "word " * rng.randint(300, 900), "b" if i % 5 == 0 else "a") for i in range(4000)]
    path = str(tmp_path / "mixed")
    corpus_pipeline.mix(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), FOLDER).write.parquet(path)
    out = corpus_pipeline.pack(spark, spark.read.parquet(path), FOLDER).collect()
    n = max(r.sequence_id for r in out) + 1
    assert {r.sequence_id for r in out} == set(range(n)) and Counter(r.doc_id for r in out) == Counter(range(4000))
    first = [r for r in out if r.sequence_id < n // 4]
    # By the roots of the sizes a third, where the rows have a fifth.
    assert 0.29 < sum(r.length for r in first if r.doc_id % 5 == 0) / sum(r.length for r in first) < 0.38


def test_stages_keep_columns(spark, docs, nothing, tmp_path):
    for name, frame in (("odd", docs), ("nothing", nothing)):
        for i, (_, step) in enumerate(corpus_pipeline.STAGES[:-1]):
            out = step(spark, frame, FOLDER)
            assert out.columns == frame.columns
            path = str(tmp_path / f"{name}{i}")
            out.write.parquet(path)
            frame = spark.read.schema(frame.schema).parquet(path)


def test_tokens_of_texts_of_all_sizes(spark, tmp_path):
    rng = random.Random(5)
    texts = ["", None, "a b", *("".join(rng.choices("abc de\n", k=k)) for k in (20, 8192, 8193, 40_000, 1 << 19, (1 << 19) + 1, 700_000)), "a b"]
    path = str(tmp_path / "documents.parquet")
    rows = [(i if i else None, t, "x", 3) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, file string, number int").repartition(3).write.parquet(path)
    encode = packing.encoder(*packing.public_files()).slow
    want = Counter((i if i else None, len(encode.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate(texts))
    assert Counter(map(tuple, tokencount.counted(spark.read.parquet(path)).collect())) == want
    assert tokencount.counted(spark.read.parquet(path).limit(0)).count() == 0


def test_mixing_spreads_rows_without_keys(spark, tmp_path):
    """Null and equal keys lie in many buckets; every source's ranks are whole, and its blocks lie where the plan says."""
    rows = [(None, "text", "a" if i % 3 else None) for i in range(4000)] + [(7, "text", "b")] * 2000
    path = str(tmp_path / "documents")
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3).write.parquet(path)
    for frame in (spark.read.parquet(path), spark.createDataFrame(rows, "doc_id long, text string, source string")):
        ranked = mixing.numbered(frame, "doc_id", "source", 512)
        assert ranked.selectExpr("source", "rank").distinct().count() == 6000
        out = mixing.mixed(frame, block_rows=8, cycle=10).collect()
        assert len({r.place for r in out}) == 6000 and Counter(r.row for r in out) == Counter(rows)
        ranks = defaultdict(set)
        for r in out:
            ranks[r.source].add((r.block, r.place % 8))
        assert {n: len(v) for n, v in ranks.items()} == {"": 1334, "a": 2666, "b": 2000}
        most = mixing.bucketed(identified(frame), "doc_id", "source", 512).groupBy("source", "bucket").count().agg({"count": "max"})
        assert most.first()[0] < 30


def test_phases_against_a_slot_by_slot_scheduler():
    """Every phase, slot by slot: the released block that is due first; all blocks of all phases, once each."""
    rng = random.Random(8)
    for _ in range(60):
        names = [f"s{i}" for i in range(rng.randint(1, 6))]
        blocks, weights = {n: rng.randint(0, 60) for n in names}, {n: rng.choice([0.2, 1, 1, 3, 7.5]) for n in names}
        cycle = rng.choice([8, 10, 25])
        plan = mixing.phases(blocks, weights, cycle)
        taken, placed = {}, Counter()
        for start in sorted({p["start"] for p in plan}):
            own = [p for p in plan if p["start"] == start]
            size, slots = own[0]["cycle"], {p["source"]: len(p["places"]) for p in own}
            done, order = Counter(), []
            for t in range(size):
                ready = [n for n in slots if done[n] < slots[n] and done[n] * size // slots[n] <= t]
                n = min(ready, key=lambda n: (-(-(done[n] + 1) * size // slots[n]), n))
                done[n] += 1
                order.append(n)
                assert all(abs(done[m] - slots[m] * (t + 1) / size) < 1 for m in slots)
            for p in own:
                assert p["first"] == placed[p["source"]]
                mine = [t for t, n in enumerate(order) if n == p["source"]]
                for j in range(p["last"] - p["first"]):
                    slot = start + j // len(mine) * size + mine[j % len(mine)]
                    assert slot == start + j // len(p["places"]) * size + p["places"][j % len(p["places"])]
                    assert slot not in taken
                    taken[slot] = p["source"]
                placed[p["source"]] = p["last"]
        assert placed == Counter({n: b for n, b in blocks.items() if b})


def test_packing_sends_few_texts_at_a_time(spark, monkeypatch):
    sizes = spark.sparkContext.accumulator(0)
    name, tokenised = "spark.sql.execution.arrow.maxRecordsPerBatch", packing._tokenised

    def counted(*args):
        run = tokenised(*args)

        def seen(batches):
            for batch in batches:
                sizes.add(batch.num_rows > 1024)
                yield from run(iter([batch]))

        return seen

    monkeypatch.setattr(packing, "_tokenised", counted)
    before = spark.conf.get(name)
    rows = spark.range(5000).coalesce(1).selectExpr("id AS doc_id", "'a text' AS text")
    # Sums are not asked for here: each batch counts anew.
    packing.pack(rows)
    assert sizes.value == 0 and spark.conf.get(name) == before


def test_slow_tokeniser_is_read_when_needed():
    encode = packing.Encoder(*packing.public_files())
    plain = encode("plain words").tolist()
    assert "slow" not in vars(encode)
    assert encode("plain words \u4e2d").tolist()[: len(plain)] == plain and "slow" in vars(encode)
