"""Removed lines against every line compared with every earlier one."""

import random
import re
from collections import Counter

from evenkeel.llm import line_dedup


def tokens(line):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), line)
    w = re.findall("[^\x20\x09-\x0d]+", low)
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, min(len(w), 1)))}


def expected(rows):
    """By id, the lines that go; ids are unique here."""
    seen, out = [], {}
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        gone = []
        for k, line in enumerate((text or "").split("\n") if text is not None else []):
            own = tokens(line)
            if own and any(100 * len(own & s) >= 75 * len(own | s) for s in seen):
                gone.append(k)
            if own:
                seen.append(own)
        out[i] = gone
    return out


def corpus():
    rng = random.Random(12)
    words = [f"w{i}" for i in range(60)]
    pool = [rng.choices(words, k=rng.choice([3, 5, 6, 12, 40])) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(pool)) if rng.random() < 0.6 else rng.choices(words, k=rng.randint(1, 30))
            for _ in range(rng.choice([0, 0, 1, 2])):
                line[rng.randrange(len(line))] = rng.choice(words)
            lines.append(rng.choice([" ", "\t "]).join(line) if rng.random() < 0.8 else " ".join(line).upper())
        rows.append((1000 - i, "\n".join(lines)))
    return rows + [(None, rows[0][1]), (5, None), (6, ""), (7, "\n\n"), (8, "the the the the the the\nthe the the the the")]


def test_against_all_lines(spark):
    rows = corpus()
    frame = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, line int, _removed string").repartition(3)
    found = {r.doc_id: (r.n_lines, r.n_removed, r.removed) for r in line_dedup.removed_lines(frame).collect()}
    want = expected(rows)
    assert found == {i: (0 if t is None else len(t.split("\n")), len(want[i]), ",".join(map(str, want[i]))) for i, t in rows}


def test_repeated_rows_empty_tables_and_texts_that_remain(spark):
    line, near = "a b c d e f g h", "A b c d e f g h"
    rows = [(1, f"{line}\nshort", "q"), (1, f"{line}\nshort", "q"), (2, f"{near}\nkeep", "q"), (3, near, "q"), (4, None, "q"), (5, "", "q"), (None, line, "q")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, same string")
    out = Counter(tuple(r) for r in line_dedup.dedup_lines(frame).collect())
    assert out == Counter([(1, f"{line}\nshort", "q")] * 2 + [(2, "keep", "q"), (4, None, "q"), (5, "", "q")])
    assert line_dedup.removed_lines(frame.limit(0)).count() == 0


def test_repeats_of_short_lines_go_from_texts(spark):
    rows = [(1, "Home | About\na b c d e f\nfour words are here"), (2, "home  | ABOUT\nother text of more than five words"), (3, "FOUR words are here"), (4, "four words are"), (5, "Home | About\nHome About")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = {r.doc_id: r.text for r in line_dedup.dedup_lines(frame).collect()}
    assert out == {1: rows[0][1], 2: "other text of more than five words", 4: "four words are", 5: "Home About"}
    assert {r.doc_id: r.removed for r in line_dedup.removed_lines(frame).collect()} == {1: "", 2: "0", 3: "0", 4: "", 5: "0"}


def test_frequent_tokens_are_counted_in_all_texts(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "FEW", 8)
    rng = random.Random(5)
    # 60 lines that share 40 words and have 30 of their own, some nearly the same as an earlier one
    shared = [f"s{i}" for i in range(40)]
    lines = [[*shared[:20], *(f"x{i}_{k}" for k in range(30)), *shared[20:]] for i in range(60)]
    near = [list(x) for x in lines[:5]]
    for x in near:
        x[rng.randrange(20, 50)] = "other"
    rows = [(i, " ".join(x)) for i, x in enumerate(lines + near)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    seen = {}

    def kept(documents, classes, first=line_dedup._rarest_first):
        found = first(documents, classes)
        for name, df in (("before", classes), ("after", found)):
            seen[name] = Counter(t for r in df.collect() for t in r.prefix)
        return found

    monkeypatch.setattr(line_dedup, "_rarest_first", kept)
    out = {r.doc_id: r.removed for r in line_dedup.removed_lines(frame).collect()}
    want = expected(rows)
    assert out == {i: ",".join(map(str, want[i])) for i, _ in rows} and sum(map(len, want.values())) == 5
    assert max(seen["before"].values()) > 50 and max(seen["after"].values()) <= 8


def test_the_order_of_tokens_changes_no_result(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "FEW", 1)
    monkeypatch.setattr(line_dedup, "FREQUENT", 40)
    rows = corpus()
    found = {r.doc_id: r.removed for r in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = expected(rows)
    assert found == {i: ",".join(map(str, want[i])) for i, _ in rows}


def test_prefixes_of_all_classes_are_written_once(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "FEW", 8)
    shared = " ".join(f"s{i}" for i in range(30))
    rows = [(i, " ".join(f"x{i}_{k}" for k in range(20))) for i in range(60)] + [(100 + i, f"{shared} y{i} z{i}" * 2) for i in range(12)]
    rows += [(200, rows[0][1]), (201, rows[1][1].replace("x1_0 ", ""))]
    wrote = []

    def counted(df, name, first=line_dedup.written):
        out = first(df, name)
        if "prefix" in out.columns:
            wrote.append((name, out.count()))
        return out

    monkeypatch.setattr(line_dedup, "written", counted)
    out = {r.doc_id: r.removed for r in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = expected(rows)
    assert out == {i: ",".join(map(str, want[i])) for i, _ in rows}
    assert want[200] == [0] and want[201] == [0]
    # a frequent token makes only the classes that have it move
    assert dict(wrote)["lines"] == len(rows) and sum(n for name, n in wrote if name != "lines") < len(rows)


def test_lines_that_share_half_are_not_read_again(spark, monkeypatch):
    # pairs of lines with half of their runs in common, and three of which one word differs
    words = lambda i, k: [f"w{i}_{j}" for j in range(k)]
    rows = [(i, " ".join(words(i, 20) + words(100 + i, 20))) for i in range(30)] + [(50 + i, " ".join(words(i, 20) + words(200 + i, 20))) for i in range(30)]
    rows += [(300 + i, rows[i][1].replace(f"w{100 + i}_19", "other")) for i in range(3)]
    read = []

    def kept(documents, named, first=line_dedup._again):
        read.append(named.count())
        return first(documents, named)

    monkeypatch.setattr(line_dedup, "_again", kept)
    out = {r.doc_id: r.removed for r in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = expected(rows)
    assert out == {i: ",".join(map(str, want[i])) for i, _ in rows} and sum(map(len, want.values())) == 3
    assert sum(read) < 15


def test_long_lines_go_by_their_prefixes(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "LONG", 10)
    monkeypatch.setattr(line_dedup, "LONG_PAIRS", 0)
    rows = corpus()
    found = {r.doc_id: r.removed for r in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = expected(rows)
    assert found == {i: ",".join(map(str, want[i])) for i, _ in rows}


def test_lines_are_grouped_without_a_sort(spark, monkeypatch):
    plans = {}

    def kept(df, name, first=line_dedup.written):
        plans.setdefault(name, df._jdf.queryExecution().executedPlan().toString())
        return first(df, name)

    monkeypatch.setattr(line_dedup, "written", kept)
    rows = [(1, "a b c d e f g h\nx"), (2, "A b c d e f g h\nx"), (2, "A b c d e f g h\nx"), (None, "x\na b c d e f g h\na b c d e f g h i")]
    out = Counter(tuple(r) for r in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == Counter([(1, 2, 0, "")] + [(2, 2, 2, "0,1")] * 2 + [(None, 3, 3, "0,1,2")])
    assert [x for x in ("repeated", "sets") if "SortAggregate" in plans[x]] == []
