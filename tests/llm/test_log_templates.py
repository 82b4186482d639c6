"""Recurring line templates against a plain version."""

import re
from collections import defaultdict

from conftest import SF

from lexweave.llm.log_templates import DEPTH, drop_recurring


def tokens_of(line):
    return ["<*>" if re.search("[0-9]", t) else t for t in re.findall(r"[^\x20\x09-\x0D]+", line)]


def plain(texts, least=3, similar=0.6, shortest=4):
    """Texts without their recurring lines, in the order given."""
    lines = []
    for text in {t for t in texts if t is not None}:
        raw = text.split("\n")
        for i, line in enumerate(raw):
            tokens = tokens_of(line)
            if len(tokens) >= shortest:
                strip = lambda j: raw[j].strip("\x20\x09\x0a\x0b\x0c\x0d") if 0 <= j < len(raw) else ""
                lines.append((text, i, tuple(tokens), (strip(i - 1), strip(i + 1))))
    leaf = lambda tokens: (len(tokens), tokens[:DEPTH])
    in_leaf = defaultdict(set)
    having = defaultdict(set)
    for text, _, tokens, _ in lines:
        in_leaf[leaf(tokens)].add(text)
        having[tokens].add(text)
    lines = [x for x in lines if len(in_leaf[leaf(x[2])]) >= least]
    support = defaultdict(int)
    for tokens in {x[2] for x in lines}:
        for at, token in enumerate(tokens):
            support[leaf(tokens), at, token] += len(having[tokens])
    texts_with, around, placed = defaultdict(set), defaultdict(set), defaultdict(set)
    templated = defaultdict(set)
    for text, i, tokens, context in lines:
        fixed = tuple((at, t) for at, t in enumerate(tokens) if t != "<*>" and support[leaf(tokens), at, t] >= least)
        if fixed and len(fixed) >= similar * len(tokens):
            key = leaf(tokens), fixed
            texts_with[key].add(text)
            around[key].add(context)
            placed[key].add((text, i))
            templated[text].add(i)
    # A witness has an eighth of its words in other lines; equal ones among these count once.
    witness = {}
    for text in templated:
        raw = [line.split() for line in text.split("\n")]
        other = [tuple(tokens_of(" ".join(x))) for i, x in enumerate(raw) if x and i not in templated[text]]
        if 8 * sum(map(len, other)) >= sum(map(len, raw)):
            witness[text] = frozenset(other)
    gone = defaultdict(set)
    for key, own in placed.items():
        apart = min(len(texts_with[key]), len(around[key])) >= least and 2 * len(around[key]) >= len(texts_with[key])
        if apart or len(texts_with[key]) >= least and len({witness[t] for t in texts_with[key] if t in witness}) >= least:
            for text, i in own:
                gone[text].add(i)
    out = []
    for text in texts:
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[text])
        out.append((kept, len(gone[text]) if text is not None else 0))
    return out


def found(df):
    return {r["doc_id"]: (r["text"], r["dropped"]) for r in drop_recurring(df, into="dropped").collect()}


def test_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    data = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = dict(zip([d for d, _ in data], plain([t for _, t in data]), strict=True))
    assert found(docs) == expected
    assert any(n for _, n in expected.values())


def test_fields_copies_and_short_lines(spark):
    own = lambda i: " ".join(chr(97 + i) + c for c in "lmnopq")
    texts = [f"{own(i)}\nUser bob{i} logged in from 10.0.0.{i}\nSee you at {w} for the meeting\nok then\nend {own(i)}"
             for i, w in enumerate(["noon", "dawn", "dusk", "night"])]
    copies = ["An only copy starts here\nits second line is long too\nand it ends like this"] * 6
    data = list(enumerate([*texts, *copies, None, "", "ok then", "\n\n"]))
    df = spark.createDataFrame([(*d, 9) for d in data], "doc_id long, text string, lines_dropped int")
    result = found(df)
    assert [result[i] for i, _ in data] == plain([t for _, t in data])
    for i in range(4):
        assert result[i] == (f"{own(i)}\nok then\nend {own(i)}", 2)
    assert all(result[i] == (copies[0], 0) for i in range(4, 10))
    assert result[10] == (None, 0) and result[11] == ("", 0)


def test_a_text_whose_lines_all_go(spark):
    line = "This very line recurs in all of them"
    data = [(i, f"{c} other words stand here today\n{line}") for i, c in enumerate("abcd")] + [(9, line)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert found(df)[9] == ("", 1)
    assert drop_recurring(df.limit(0)).collect() == []


def unlike(i, n):
    """Lines that no other document has, and whose first words differ."""
    return [" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + k)}{c}" for c in "lmnopq") for k in range(n)]


def test_passages_go_whole(spark):
    """Passages of 2, 3 and 6 lines at the start, in the middle and at the end of unlike texts."""
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    data, expected = [], {}
    for size in (2, 3, 6):
        for at in (0, 3, 6):
            passage = [f"{words[k]} of {words[size - 1]} {words[at - 1]} holds in all" for k in range(size)]
            for _ in range(5):
                own = unlike(len(data), 6)
                expected[len(data)] = ("\n".join(own), size)
                data.append((len(data), "\n".join([*own[:at], *passage, *own[at:]])))
    assert found(spark.createDataFrame(data, "doc_id long, text string")) == expected


def test_a_footer_that_is_most_of_its_document(spark):
    """Three lines recur in 200 documents of four and of five lines: all three go everywhere."""
    footer = ["Contact our office for more information", "All rights are kept by the owners", "This page was last changed today"]
    data = [(i, "\n".join([*unlike(i, 1 + i % 2), *footer])) for i in range(200)]
    result = found(spark.createDataFrame(data, "doc_id long, text string"))
    assert result == {i: ("\n".join(unlike(i, 1 + i % 2)), 3) for i, _ in data}


def test_near_copies_shield_no_line_and_stay(spark):
    """A line of 10 unlike texts is also in 60 near copies, which lose it and nothing else."""
    line = "This very line recurs in all of them"
    body = unlike(600, 12)
    data = [(i, "\n".join([*unlike(i, 3), line, *unlike(i + 100, 3)])) for i in range(10)]
    for i in range(10, 70):
        own = list(body)
        own[i % 12] = own[i % 12][:-4] + " changed" + chr(97 + i % 26) + chr(97 + i // 26)
        data.append((i, "\n".join([*own[:6], line, *own[6:]])))
    result = found(spark.createDataFrame(data, "doc_id long, text string"))
    assert result == {i: (t.replace(line + "\n", ""), 1) for i, t in data}
