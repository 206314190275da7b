"""Terms that disclose: against the plain definition, and what is paired on long lists."""

import math
import random
import re
from collections import defaultdict

import pytest
import regex

from pulsebook.llm import pii

FOLDER = "/root/testdata/sf0.01"


def plain_terms(texts, base, support, share):
    """Term spans by the definition, from each text's base spans (kind, start, end)."""
    terms = [[(m.start(), m.end(), m[0].lower()) for m in regex.finditer(r"\p{L}[\p{L}\p{N}'-]{3,}+", t)] for t in texts]
    n_term, n_both, holders, of_row = defaultdict(int), defaultdict(list), defaultdict(list), defaultdict(set)
    for i, text in enumerate(texts):
        for kind, start, end in base[i]:
            value = text[start:end]
            of_row[i].add((kind, re.sub("[^0-9]", "", value) if kind in ("card", "phone") else value.lower()))
        for e in of_row[i]:
            holders[e].append(i)
        for t in {t for *_, t in terms[i]}:
            n_term[t] += 1
            for e in of_row[i]:
                n_both[e, t].append(i)
    n, told = len(texts), defaultdict(set)
    for (e, t), rows in n_both.items():
        if len({texts[i] for i in rows}) >= support:
            pmi = math.log(n * len(rows) / (n_term[t] * len(holders[e])))
            if pmi >= share * math.log(n / len(holders[e])) - 1e-9:
                for i in rows:
                    told[i].add(t)
    return {
        (i, a, b) for i, own in told.items() for a, b, t in terms[i]
        if t in own and not any(a < end and start < b for _, start, end in base[i])
    }


@pytest.mark.parametrize("support, share", [(2, 0.9), (2, 0.5), (3, 0.7)])
def test_against_the_definition(spark, support, share):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").orderBy("doc_id").collect()]
    texts = [t or "" for _, t in rows][:500] + ["mail zeb@x.org to Zebulon", "Zebulon reads zeb@x.org", "zeb@x.org and qu@x.org by Zebulon", "qu@x.org Quillon"] * 2
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    keys, spans = pii.detect(frame, support=support, share=share)
    base, got = defaultdict(list), set()
    for r in keys.join(spans, "row").collect():
        if r.kind == "term":
            got.add((r.key, r.start, r.end))
        else:
            base[r.key].append((r.kind, r.start, r.end))
    assert got and got == plain_terms(texts, base, support, share)


def test_long_lists_are_paired_by_classes(spark, monkeypatch):
    rng, paired = random.Random(3), []
    words = ["".join(rng.choices("abcdefghijklmnop", k=12)) for _ in range(1500)]
    listed = " ".join(f"{w} p{i}@host{i}.org" for i, w in enumerate(words))
    texts = [listed, listed + " again", words[0] + " alone", "p1@host1.org", *(f"other words {i}" for i in range(50))]
    stage = pii.stage

    def counted(df, name):
        out = stage(df, name)
        if name == "pairs":
            paired.append(out.count())
        return out

    monkeypatch.setattr(pii, "stage", counted)
    keys, spans = pii.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    # Two lists; the addresses are of two classes, the words of three or so.
    assert paired[0] <= 20
    found = {(r.key, r.start) for r in keys.join(spans, "row").where("kind = 'term'").collect()}
    assert len(found) >= 2 * 1490
