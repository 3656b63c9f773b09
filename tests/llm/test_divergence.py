"""Source divergence audit against a plain count."""

import re
from collections import Counter, defaultdict

import pytest

from seqprep.llm import divergence
from tests.llm.cases import SCHEMA, as_rows, clashing, prose

TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def plain(rows, least, most=50):
    rows = [(lang or "", source or "", Counter(TERMS.findall((text or "").translate(LOWER)))) for text, lang, source in rows]
    documents, counts, whole, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, found in rows:
        documents[lang].update(set(found))
        counts[lang, source].update(found)
        whole[lang].update(found)
        sources[lang].add(source)
    out = []
    for lang, own in sources.items():
        kept = [t for t, n in documents[lang].items() if n >= least]

        def shares(held):
            n = sum(held[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (held[t] + 5) // n for t in kept}

        q, p = shares(whole[lang]), {s: shares(counts[lang, s]) for s in own}
        for s in own:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in own if o != s]
            terms = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, most)):
                order = sorted(found, key=lambda f: (-f[1], f[0].encode()))[:limit]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(order, 1)]
    return sorted(out, key=repr)


def rows():
    made = []
    for k in range(60):
        lang, source = ["en", "de", None, ""][k % 4], ["a", "b", "é", None, "", "c"][k % 6]
        made.append((prose(k % 9, 40) + " ÀB été_Zz9zz", lang, source))
    made += [(None, "en", "quiet"), ("", "en", "blank"), ("12 34", "fr", "x"), (None, "fr", "y"), ("only one", "it", "z")]
    made += [(prose(1, 30), "en", "a")] * 5 + [("long " * 5000 + prose(3, 3000), "en", "b")]
    return made


def frame(spark, made):
    return spark.createDataFrame([(k, t, lang, s, 0) for k, (t, lang, s) in enumerate(made)], SCHEMA).repartition(5)


@pytest.mark.parametrize("width, block, page, cells", [(512, 400_000, 512, 1 << 21), (2, 50, 3, 40), (1, 1, 1, 1)])
def test_divergence(spark, monkeypatch, width, block, page, cells):
    for name, value in (("WIDTH", width), ("PAGE", page), ("CELLS", cells), ("TERM_SHARDS", 3)):
        monkeypatch.setattr(divergence, name, value)
    got = as_rows(divergence.divergence(frame(spark, rows()), least=4, block=block))
    assert got == plain(rows(), 4)
    assert {r[2] for r in got} == {"pair", "term"} and any(r[0] == "fr" and r[4] == 0 for r in got)


def test_only_the_highest_terms(spark):
    made = [(" ".join(chr(97 + i // 26) + chr(97 + i % 26) for i in range(200)), "en", "a")] * 3 + [("zz " * 50, "en", "b")] * 3
    assert as_rows(divergence.divergence(frame(spark, made), least=3)) == plain(made, 3)


def test_clashing_columns_and_nothing(spark):
    docs = frame(spark, rows())
    more = clashing(docs).selectExpr("*", "1 as g", "2 as p", "3 as term", "4 as value", "5 as item")
    assert as_rows(divergence.divergence(more, least=4)) == plain(rows(), 4)
    assert divergence.divergence(docs.limit(0)).collect() == []


def test_pieces_hold_every_term_once():
    text = "Aa bb,cc\u00e9 d" * 50
    whole = text.encode().translate(divergence._TERMS).split()
    for size in (1, 2, 7, 10_000):
        assert [t for piece in divergence.pieces(text.encode(), size) for t in piece] == whole


def test_long_sums_stay_exact(spark):
    df = spark.range(1).selectExpr("9000000000000000000 as c", "9000000000000000100 as n", "7L as v")
    made = df.select(divergence.share(df.c, df.n, df.v)).first()[0]
    assert made == 1 + 10**9 * (9 * 10**18 + 5) // (9 * 10**18 + 100 + 35)
