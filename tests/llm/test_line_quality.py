"""Line rules against a plain version."""

import re
from collections import Counter

from conftest import SF

from lexweave.llm.line_quality import line_quality

DIGITS = str.maketrans("123456789", "0" * 9)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def line_of(line):
    return " ".join(words_of(lower(line).translate(DIGITS)))


def plain(rows, most_documents=20, most_share=0.002, least_words=50, least_part=0.3):
    hosts = Counter(host for _, _, host in rows)
    held = Counter()
    for _, text, host in rows:
        held.update((host, line) for line in {line_of(x) for x in (text or "").split("\n")} - {""})
    out = []
    for doc, text, host in rows:
        words, lines = words_of(text), [x for x in (text or "").split("\n") if words_of(x)]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        twice = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if twice[w] > 1 for k in range(3)}
        removed = [x for x in lines if held[host, line_of(x)] > most_documents + most_share * hosts[host]]
        gone = sum(len(words_of(x)) for x in removed)
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        left = len(words) - gone
        out.append((
            doc, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered), failed,
            not failed and left >= least_words and left >= least_part * len(words), len(removed), gone,
        ))
    return sorted(out, key=repr)


def found(df, **limits):
    return sorted(map(tuple, line_quality(df, **limits).collect()), key=repr)


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    assert found(docs) == plain(rows)
    assert found(docs, most_documents=1, most_share=0.0) == plain(rows, 1, 0.0)


def test_hard_rows(spark):
    body = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"Shared Line 12\n{body} {i}\nshared  line 99", "h") for i in range(5)]
    rows += [(None, None, None), (7, "", None), (8, " \n\t\n", "h"), (9, "a b c a b c a b c", "h")]
    rows += [(1, "Shared line 00\n" + body, "g")] * 3 + [(11, "x " * 3000 + "é🙂#|", "h")]
    df = spark.createDataFrame([(*r, 1, "k") for r in rows],
                               "doc_id long, text string, source string, n_words int, _key string")
    limits = {"most_documents": 2, "most_share": 0.1}
    assert found(df, **limits) == plain(rows, **limits)
    assert found(df.limit(0)) == []


def test_texts_without_common_lines(spark):
    """The texts lose the lines, and the words, that the verdict counts; nothing else changes."""
    from lexweave.llm.line_quality import without_common_lines

    body = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"Shared Line 12\n{body} {chr(97 + i)}\n\nshared  line 99\n", "h") for i in range(5)]
    rows += [(None, None, None), (7, "", None), (8, " \n\t\n", "h"), (9, "SHARED line 00", "h")]
    rows += [(1, "Shared line 00\n" + body, "g"), (1, "Shared line 00\n" + body, "g")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, source string, _key string")
    limits = {"most_documents": 2, "most_share": 0.1}
    cleaned = without_common_lines(df, **limits)
    assert cleaned.columns == df.columns
    expected = [(i, f"{body} {chr(97 + i)}\n\n", "h", "k") for i in range(5)]
    expected += [(*r, "k") for r in rows[5:8]] + [(9, "", "h", "k")] + [(*r, "k") for r in rows[9:]]
    assert sorted(map(tuple, cleaned.collect()), key=repr) == sorted(expected, key=repr)
    counted = sorted((r[0], r[1] - r[-1]) for r in plain(rows, **limits) if r[0] is not None)
    assert sorted((r["doc_id"], len(words_of(r["text"]))) for r in cleaned.collect() if r["doc_id"] is not None) == counted


def test_texts_are_read_once(spark):
    """Splitting is the work: base counts, line counts and removed lines come from one reading."""
    from pyspark.sql import functions as F

    from lexweave.llm.line_quality import without_common_lines

    body = " ".join(f"w{i}" for i in range(60))
    rows = [(i, f"Shared Line 12\n{body} {i}\nshared  line 99", "h") for i in range(5)]
    limits = {"most_documents": 2, "most_share": 0.1}
    for run, reads in ((line_quality, 1), (without_common_lines, 2)):
        seen = spark.sparkContext.accumulator(0)

        def mark(text, seen=seen):
            seen.add(1)
            return text

        marked = F.udf(mark, "string").asNondeterministic()("text").alias("text")
        df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(1)
        run(df.select("doc_id", marked, "source"), **limits).collect()
        assert seen.value == reads * len(rows)


def test_characters_of_every_kind(spark):
    """Blanks are six characters only; letters A-Z and digits 0-9 alone are made equal."""
    texts = [" \n \n\x1c\n\x85  x\n\x00", "\x0b\x0c\r\n \t\nA\rB\x0bC\x0cD\n\n a b c d\nÉ É\né é",
             "İI ıi KK\nii ii kk\nΣΑΣ σας\n٣ 3\n٣ 4", "#*$%&|<>" * 3 + " ##€\n&&||", "x\n" * 40 + " x\n" * 2,
             " ".join(["a b c", "d"] * 30), "🙂 🙂 🙂 🙂\n🙂 🙂 🙂 🙂\n", "a\n \nb \nb\n b", "\n", "A" * 5000 + "1 \t 9" + "\n0 0\n5 7"]
    rows = [(i * 2 + k, t, "h" if i % 3 else None) for i, t in enumerate(texts) for k in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for most in (0, 1, 2):
        limits = {"most_documents": most, "most_share": 0.0, "least_words": 2}
        assert found(df, **limits) == plain(rows, **limits)
