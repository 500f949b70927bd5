from conftest import DATA, same_rows

from llm import line_dedup as ld


def test_query_matches_sql(spark, duck):
    same_rows(ld.op2_line_dedup(spark, DATA), duck, ld.OP2_SQL)


def run(spark, rows, kind="doc_id long, text string"):
    return ld.dedup_lines(spark.createDataFrame(rows, kind))


def test_later_windows_go_and_covered_lines_merge(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb"), (4, "d\nc\nb")]
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in run(spark, rows).collect()}
    assert got == {1: ("a\nb\nc\nd", 4, 0), 2: ("x\ny", 6, 4), 3: ("a\nb", 2, 0), 4: ("d\nc\nb", 3, 0)}


def test_windows_that_repeat_inside_a_text(spark):
    got = run(spark, [(1, "a\na\na\na\nb")]).first()
    assert (got.text, got.n_removed) == ("a\nb", 3)


def test_order_and_copies(spark):
    rows = [(5, "a\nb\nc"), (2, "a\nb\nc"), (None, "a\nb\nc")]
    got = sorted(((r.doc_id, r.text) for r in run(spark, rows).collect()), key=str)
    assert got == sorted([(2, "a\nb\nc"), (5, ""), (None, "")], key=str)


def test_nulls_blanks_repeated_rows_and_clashing_columns(spark):
    kind = "doc_id long, text string, n_lines string, covered int, th int, id int, n_chars long"
    rows = [(1, None, "k", 1, 2, 3, 0), (2, "", "k", 1, 2, 3, 0), (3, "\n\n\n\n", "k", 1, 2, 3, 4), (4, "\n\n\n\n", "k", 1, 2, 3, 4), (6, "a\nb\nc", "k", 1, 2, 3, 5), (6, "a\nb\nc", "k", 1, 2, 3, 5), (7, "a\nb\nc\nd", "k", 1, 2, 3, 7)]
    out = run(spark, rows, kind)
    got = sorted((r.doc_id, r.text, r.n_removed, r.n_chars) for r in out.where("doc_id > 1").collect())
    assert got == [(2, "", 0, 0), (3, "\n\n\n\n", 0, 4), (4, "\n\n\n\n", 0, 4), (6, "a\nb\nc", 0, 5), (6, "a\nb\nc", 0, 5), (7, "d", 3, 1)]
    one = out.where("doc_id = 1").first()
    assert one.text is None and one.n_lines == 0 and one.covered == 1 and one.th == 2
    assert run(spark, rows, kind).limit(0).count() == 0
    assert ld.dedup_lines(spark.createDataFrame([], kind)).count() == 0


def test_long_text(spark):
    long = "\n".join(f"line {i}" for i in range(20000))
    got = {r.doc_id: r.n_removed for r in run(spark, [(1, long), (2, "head\n" + long)]).collect()}
    assert got == {1: 0, 2: 20000}
