import re

from pyspark.sql import functions as F

from telemetry_spark.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_force(docs):
    out = []
    for key, text in docs:
        words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        at = [(i, label) for phrase, label in licenses.BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
        places = [i for i, _ in at]
        out.append((str(key), len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))))
    return sorted(out, key=repr)


def rows_of(frame):
    return sorted(((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in frame.collect()), key=repr)


def test_base_phrases_in_the_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute_force([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert rows_of(licenses.scan(docs)) == want and any(r[2] for r in want)


def test_texts_and_odd_rows(spark, odd_documents):
    mit = dict((t[0], t[1]) for t in licenses.TEXTS)["mit"]
    many = " and ".join(t[1] for t in licenses.TEXTS)
    texts = [
        (30, f"Preface. {mit.upper()}"), (31, "permission is hereby given free of charge to any person"), (32, many),
        (33, "MIT-License; mit license / CC (by) 4.0, GNU General Public License v3"), (34, "license mit by cc public general gnu"),
        (35, "cc by " * 500), (36, mit.replace("without restriction", "with restriction")),
    ]
    docs = odd_documents.select("doc_id", "text", F.lit(3).alias("row"), F.lit("x").alias("label")).unionByName(
        spark.createDataFrame(texts, "doc_id bigint, text string").withColumns({"row": F.lit(3), "label": F.lit("x")}))
    found = licenses.scan(docs)
    assert rows_of(found) == brute_force([tuple(r) for r in docs.select("doc_id", "text").collect()])
    labels = {r.doc_id: (r.labels, r.score) for r in found.collect()}
    assert labels[30] == ("mit", 1.0) and labels[31] == ("", 0.0) and labels[34] == ("", 0.0) and labels[36][0] == "mit"
    assert set(labels[32][0].split(",")) == {t[0] for t in licenses.TEXTS} and labels[1] == ("", 0.0)
    assert licenses.scan(docs.limit(0)).count() == 0


def brute_labels(texts, found_words):
    """Labels of the text templates: the phrase stands word for word, and with it enough of the template's weight."""
    known = [t for t in licenses.templates() if not t.base]
    idf = licenses.idf_of(licenses.templates(), found_words, len(texts))
    out = {}
    for key, text in texts:
        words, labels = WORD.findall(text.lower()), set()
        for t in known:
            total = sum(idf[w] for _, w in t.indexed)
            for at in range(-len(t.words), len(words)):
                stands = [0 <= at + i < len(words) and words[at + i] == w for i, w in enumerate(t.words)]
                if at >= 0 and all(stands[slice(*t.mandatory)]) and sum(idf[w] for i, w in t.indexed if stands[i]) >= licenses.LEAST_SHARE * total:
                    labels.add(t.label)
        out[key] = labels
    return out


def test_a_phrase_stands_only_as_a_whole(spark):
    """One changed word of a mandatory phrase, a function word too, takes the label away; a changed word elsewhere need not."""
    texts, key = [], 0
    for label, text, phrase in licenses.TEXTS:
        words, own = text.split(), phrase.split()
        start = next(i for i in range(len(words)) if words[i : i + len(own)] == own)
        for place in range(len(words)):
            texts.append((key, " ".join(["before", *words[:place], "qq", *words[place + 1 :], "after"]), label, start <= place < start + len(own)))
            key += 1
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id bigint, text string")
    got = {r.doc_id: set(filter(None, r.labels.split(","))) - {b for _, b in licenses.BASE if b in r.base_labels.split(",")} for r in licenses.scan(docs).collect()}
    vocabulary = {w for t in licenses.templates() for _, w in t.indexed}
    counts = {w: sum(w in set(t[1].split()) for t in texts) for w in vocabulary}
    want = brute_labels([t[:2] for t in texts], counts)
    base = {key: {b for phrase, b in licenses.BASE if phrase in text} for key, text, *_ in texts}
    for key, _, label, inside in texts:
        assert got[key] == want[key] - base[key]
        assert not (inside and label in want[key])
    assert sum(label in want[key] for key, _, label, inside in texts) > 50
