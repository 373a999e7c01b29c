import re

from llm_fixtures import frame, sentence
import random

from clientele.llm.decontaminate import decontaminate, drop_contaminated

WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = "item_id long, text string, doc_id long, row string"


def words(text):
    return WORDS.findall((text or "").encode().lower())


def brute(rows, items):
    windows = {}
    for item, text, *_ in items:
        w = words(text)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text, *_ in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i:i + n]))
                if got:
                    hit |= set(range(i, i + n))
                    found |= got
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def case(rows):
    rng = random.Random(9)
    passage = sentence(rng, 30)
    items = [(1, passage), (2, passage.upper()), (10, " ".join(passage.split()[5:25])), (3, "short item"),
             (4, ""), (5, None), (6, "?!"), (7, "alone"), (None, sentence(rng, 12)), (8, "é ñ ß 中文"),
             (9, "a a a a a a a a a a a a")]
    more = [(900 + i, t, "en", "s0", 1) for i, t in enumerate([
        passage, "x " + passage.replace(" ", ", ") + " y", " ".join(passage.split()[:9]),
        " ".join(passage.split()[3:13]), "some short item here", items[8][1], passage + " " + passage])]
    return rows + more, [(i, t, 1, "x") for i, t in items]


def test_matches_brute_force(spark, rows):
    rows, items = case(rows)
    found = decontaminate(frame(spark, rows, clashing=True), spark.createDataFrame(items, ITEMS))
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()]
    assert sorted(map(str, got)) == sorted(map(str, brute(rows, items)))


def test_drop_contaminated_keeps_clean_rows(spark, rows):
    rows, items = case(rows)
    docs = frame(spark, rows, clashing=True)
    kept = drop_contaminated(docs, spark.createDataFrame(items, ITEMS))
    assert kept.columns == docs.columns
    want = [r[0] for r, b in zip(rows, brute(rows, items)) if b[2] == 0]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, want))


def test_empty_tables(spark, no_docs, rows):
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate(no_docs, none).count() == 0
    assert {r.n_hit for r in decontaminate(frame(spark, rows), none).collect()} == {0}
