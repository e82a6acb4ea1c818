import hashlib
import random

from tallyforge.llm import linededup

from .conftest import rows_of_edge


def brute(rows, min_line=3, min_block=8):
    """The same rule without Spark: align each document with the first holder of each of its lines."""
    docs = sorted({(i is None, i if i is not None else 0, t or "") for i, t in rows})
    first = {}
    for d in docs:
        for p, line in enumerate(d[2].split("\n")):
            if len(line.split()) >= min_line:
                first.setdefault(line, (d, []))
                if first[line][0] == d:
                    first[line][1].append(p)
    gone = {}
    for d in docs:
        lines = d[2].split("\n")
        groups = {}
        for p, line in enumerate(lines):
            if line in first and first[line][0] != d:
                groups.setdefault(first[line][0], []).append((p, line))
        aligned = set()
        for owner, mine in groups.items():
            theirs = sorted({(p, line) for _, line in mine for p in first[line][1]})
            aligned |= {a for a, _ in linededup.patience(mine, theirs)}
        out, block = [], []
        for p in [*sorted(aligned), None]:
            if block and (p is None or p != block[-1] + 1):
                if sum(len(lines[q].split()) for q in block) >= min_block:
                    out += block
                block = []
            if p is not None:
                block.append(p)
        gone[d[1:]] = out
    return {k: ",".join(map(str, v)) for k, v in gone.items()}


def lcs_is_monotone(pairs):
    return all(a[0] < b[0] and a[1] < b[1] for a, b in zip(pairs, pairs[1:]))


def test_patience_aligns_in_order():
    rng = random.Random(0)
    for _ in range(500):
        a = [(i, rng.choice("abcdefghij")) for i in range(rng.randrange(12))]
        b = [(i, rng.choice("abcdefghij")) for i in range(rng.randrange(12))]
        pairs = linededup.patience(a, b)
        assert lcs_is_monotone(pairs) and all(a[x][1] == b[y][1] for x, y in pairs)
    a = list(enumerate("abcXdef"))
    assert linededup.patience(a, list(enumerate("abcdef"))) == [(0, 0), (1, 1), (2, 2), (4, 3), (5, 4), (6, 5)]
    long = [(i, i) for i in range(50_000)]
    assert len(linededup.patience(long, long)) == 50_000


def test_shared_blocks_go_from_the_later_document(frame):
    block = "this passage of many words\nstands in two documents\nand in the same order"
    texts = [f"first one starts here\n{block}\nend of first", f"another start line here\n{block}\nanother end line", "of.\nof."]
    rows = {r.doc_id: r for r in linededup.line_report(frame(texts)).collect()}
    assert rows[0].n_deleted == 0 and rows[1].deleted == "1,2,3" and rows[2].n_deleted == 0
    kept = {r.doc_id: r.text for r in linededup.without_shared_lines(frame(texts)).collect()}
    assert kept[1] == "another start line here\nanother end line" and kept[0] == texts[0]


def test_random_documents_with_a_very_common_line(frame):
    rng = random.Random(7)
    pool = [f"line {i} has some words {i * 3} in it" for i in range(40)] + ["short one", "", "a b c"]
    texts = []
    for _ in range(150):
        lines = [rng.choice(pool) for _ in range(rng.randrange(8))] + ["the line that everyone has in common here today"] * (rng.random() < 0.6)
        rng.shuffle(lines)
        texts.append("\n".join(lines))
    texts += texts[:20]
    want = brute(list(enumerate(texts)))
    for r in linededup.line_report(frame(texts)).collect():
        text = texts[r.doc_id]
        assert r.deleted == want[r.doc_id, text]
        gone = set(map(int, filter(None, r.deleted.split(","))))
        left = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone) if gone else text
        assert r.kept_sha256 == hashlib.sha256(left.encode()).hexdigest() and r.n_lines == len(text.split("\n"))


def held_before(rows, min_block=8):
    """Lines of every run of two or more lines, with words on its first and last, that stands in an earlier document."""
    docs = sorted({(i is None, i if i is not None else 0, t or "") for i, t in rows})
    seen, out = set(), {}
    for d in docs:
        lines = d[2].split("\n")
        size = [len(x.split()) for x in lines]
        runs = [(a, b) for a in range(len(lines)) for b in range(a + 2, len(lines) + 1)
                if size[a] and size[b - 1] and sum(size[a:b]) >= min_block]
        out[d[1:]] = {p for a, b in runs if tuple(lines[a:b]) in seen for p in range(a, b)}
        seen |= {tuple(lines[a:b]) for a, b in runs}
    return out


def query_rows(spark, folder, tmp_path, df):
    from tallyforge.llm.queries import QUERIES

    df.write.parquet(f"{tmp_path}/documents.parquet")
    return {r.doc_id: r.deleted for r in QUERIES["op4_line_dedup"](spark, str(tmp_path)).collect()}


def test_passages_whose_lines_an_older_text_holds_in_another_order(spark, folder, frame, tmp_path):
    lines = [f"line {i} of the passage" for i in range(20)]
    shuffled = random.Random(1).sample(lines, 20)
    texts = ["\n".join(shuffled), "start of b\n" + "\n".join(lines), "other start of c\n" + "\n".join(lines), "\n".join(lines[:4] * 3), "\n".join(lines[:4] * 2)]
    got = query_rows(spark, folder, tmp_path, frame(texts))
    assert got[0] == "" and got[2] == ",".join(map(str, range(1, 21))) and got[4] == "0,1,2,3,4,5,6,7"
    assert "0" not in got[1].split(",") and len(got[1].split(",")) < 20  # b keeps what no earlier text has in its order


def test_passages_of_short_and_blank_lines(spark, folder, frame, tmp_path):
    words = "\n".join(f"item{i}" if i % 3 else f"two item{i}" for i in range(50))
    verse = "\n\n".join(f"verse line number {i}" for i in range(6))
    texts = [f"a list\n{words}\nend", f"start\nof another\n{words}", f"{verse}\nend of a", f"before it\n\n{verse}\n\nafter it", verse.replace("\n\n", "\n \n")]
    got = query_rows(spark, folder, tmp_path, frame(texts))
    assert got == {0: "", 1: ",".join(map(str, range(2, 52))), 2: "", 3: ",".join(map(str, range(2, 13))), 4: ""}


def test_query_equals_all_runs_with_short_lines(spark, folder, frame, tmp_path):
    check_all_runs(spark, folder, frame, tmp_path, ["a b c", "d e f", "g h i j", "n o p q r s t u", "one", "two", "three", "five six", "", " "])


def test_query_equals_all_runs_of_lines(spark, folder, frame, tmp_path):
    check_all_runs(spark, folder, frame, tmp_path, ["a b c", "d e f", "g h i j", "k l m", "n o p q r s t u", "v w x"])


def check_all_runs(spark, folder, frame, tmp_path, pool):
    rng = random.Random(11)
    texts = ["\n".join(rng.choice(pool) for _ in range(rng.randrange(9))) for _ in range(120)]
    rows = list(enumerate(texts))
    aligned, held = brute(rows), held_before(rows)
    got = query_rows(spark, folder, tmp_path, frame(texts))
    for key in aligned:
        assert got[key[0]] == ",".join(map(str, sorted({*map(int, filter(None, aligned[key].split(","))), *held[key]})))


def test_no_line_is_lost(documents):
    before = {line for r in documents.collect() for line in r.text.split("\n")}
    after = {line for r in linededup.without_shared_lines(documents).collect() for line in r.text.split("\n")}
    assert before - after == set()


def test_edges_and_empty(edge, none):
    rows = linededup.line_report(edge).collect()
    assert len(rows) == len(rows_of_edge())
    want = brute([(r[0], r[1]) for r in rows_of_edge()])
    texts = {r[0]: r[1] or "" for r in rows_of_edge()}
    assert all(r.deleted == want[r.doc_id or 0, texts[r.doc_id]] for r in rows)
    out = linededup.without_shared_lines(edge)
    assert out.columns == edge.columns and out.count() == len(rows_of_edge())
    assert linededup.line_report(none).count() == 0
