from __future__ import annotations

import hashlib
import re

from orderlayers.llm.pii import personal_data, redact, train_span_classifier, vote_patterns, with_spans

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20\-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ODD = [
    "a@b.c_d@e.f g@h.i.j@k.l a@b a@b. a@b..c a@-.-",
    "1.2.3.4.5.6.7.8 999.1.1.1 001.002.003.004 0000000000000000001.1.1.1 1.1.1.99999999999999999999",
    "+1 (415) 555-2671 and 4111 1111 1111 1111 x 4111-1111-1111-1111 y 4111111111111112",
    "+4111111111111111 é+49 30 123456-78 x ++1 2 3 4 5 6 7 8 9 0 1+12345678901",
    "1" * 20000 + " " + "1 " * 5000,
    "a" * 20000 + "@" + "b.c" * 50,
    None,
    "",
]


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        luhn = sum(int(c) if k % 2 == 0 else (2 * int(c) - 9 if c > "4" else 2 * int(c)) for k, c in enumerate(digits[::-1]))
        return 14 <= len(digits) <= 19 and luhn % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            if passes(kind, m[0]):
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def test_base_equals_brute_force_and_stays_in_the_spans(docs, small_docs):
    frame = docs(*((10**6 + k, t) for k, t in enumerate(ODD))).select("doc_id", "text").union(
        small_docs.select("doc_id", "text")
    )
    texts = {x["doc_id"]: x["text"] for x in frame.collect()}
    rows = personal_data(frame).collect()
    assert len(rows) == len(texts)
    for row in rows:
        spans = base(texts[row["doc_id"]])
        joined = [f"{kind}:{start}:{end}" for start, _, end, kind in spans]
        assert row["base_sha256"] == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert [row[f"n_{k}"] for k in PATTERNS] == [sum(s[3] == k for s in spans) for k in PATTERNS]
        assert set(joined) <= set(row["spans"].split(",")) | {""}
        assert row["n_spans"] == len(row["spans"].split(",")) - (row["spans"] == "")


SECRETS = [f'word token = "{hashlib.sha1(str(k).encode()).hexdigest()}" word' for k in range(30)]
WORDS = [f"a Krankenversicherungs{k}karte and wordwordwordwordwordword{k % 10} here" for k in range(30)]


def test_classifier_takes_secrets_and_leaves_long_words(docs):
    frame = docs(*SECRETS, *WORDS, "ssn 123-45-6789 call (415) 555-2671, Dr. Smith Jones")
    weights = train_span_classifier(frame)
    rows = {x["doc_id"]: [s["kind"] for s in x["pii"]["spans"]] for x in with_spans(frame, weights).collect()}
    assert all(rows[k] == ["secret"] for k in range(30))
    assert all(rows[k] == [] for k in range(30, 60))
    assert rows[60] == ["ssn", "local_phone", "name"]


def test_redact_keeps_columns_rows_and_clean_texts(docs):
    frame = docs((1, "mail a@b.cd now", "en", "s"), (2, "clean", None, "s"), (3, None), (3, None), (4, "+4111111111111111"))
    clashing = frame.withColumnRenamed("source", "pii").withColumn("__base", frame.lang)
    found = redact(clashing, None)
    assert found.columns == clashing.columns
    assert sorted((x["doc_id"], str(x["text"])) for x in found.collect()) == [
        (1, "mail <EMAIL> now"), (2, "clean"), (3, "None"), (3, "None"), (4, "+<CARD>"),
    ]


def test_without_candidates_or_rows(docs):
    assert train_span_classifier(docs("nothing here")) is None
    assert personal_data(docs("x").limit(0)).count() == 0


def test_main_path_runs_no_python(docs):
    frame = docs("a")
    for out in (vote_patterns(frame), with_spans(frame, {"bias": 1.0, "kind secret": 0.5, "0 1": 1.0}), redact(frame, None)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_a_secret_may_begin_with_many_letters(docs):
    late = "Abcdef-Ghij_klmn" * 4 + "9182xy" + "7736"
    frame = docs(f'word token = "{late}" word', f'word token = "{"a" * 100_000}" word', "b" * 100_000 + "1234")
    rows = redact(frame, {"bias": 1.0}).orderBy("doc_id").collect()
    assert rows[0]["text"] == 'word token = "<SECRET>" word'
    assert rows[1]["text"] == f'word token = "{"a" * 100_000}" word'
    assert rows[2]["text"] == "<SECRET>"
