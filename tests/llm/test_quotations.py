import pytest

from pyspark.sql import functions as F

from churnkit.llm.common import read_table
from churnkit.llm.quotations import answered, as_mail, link_quotations
from tests.oracle import DATA

SCHEMA = "conv_id long, turn int, role string, text string, hash string, position string, source string"


def linked(spark, rows):
    df = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in link_quotations(df).collect()), key=str)


def test_nested_quotes_find_their_messages(spark):
    rows = [
        (1, 0, "user", "How do I sort?\nPlease help"),
        (1, 1, "assistant", "> How do I  SORT?\nUse sort."),
        (1, 2, "user", "a branch\nof its own"),
        (1, 5, "user", ">> How do I sort?\n> Use sort.\nThanks"),
        (1, 7, "user", "> > a line nobody wrote\n> Please help\nstill open"),
    ]
    assert linked(spark, rows) == [
        (1, 0, "user", 0, None, 0, 0, "How do I sort?\nPlease help"),
        (1, 1, "assistant", 1, 0, 1, 1, "Use sort."),
        (1, 2, "user", 2, 1, 0, 0, "a branch\nof its own"),
        (1, 5, "user", 3, 1, 2, 2, "Thanks"),
        (1, 7, "user", 4, 0, 2, 1, "still open"),
    ]


def test_the_passage_with_most_lines_and_the_latest_message_decide(spark):
    rows = [
        (1, 0, "user", "one\ntwo\nthree"),
        (1, 1, "user", "one"),
        (1, 2, "user", "> one\nmid\n> two\n> three\nend"),
        (1, 3, "user", "> one\nx"),
    ]
    found = {r[1]: r[4] for r in linked(spark, rows)}
    assert found == {0: None, 1: 0, 2: 0, 3: 1}


def test_defined_cases(spark):
    rows = [
        (1, 0, "user", None),
        (1, 1, "user", "> "),
        (1, 2, "user", ""),
        (1, 2, "user", ""),
        (1, None, "user", "> lost"),
        (None, 0, "user", "> lost"),
        (2, 0, "user", "> only quotes"),
    ]
    assert linked(spark, rows) == sorted([
        (1, 0, "user", 0, None, 0, 0, None),
        (1, 1, "user", 1, 0, 1, 0, ""),
        (1, 2, "user", 2, 1, 0, 0, ""),
        (1, 2, "user", 2, 1, 0, 0, ""),
        (1, None, "user", None, None, 0, 0, "> lost"),
        (None, 0, "user", None, None, 0, 0, "> lost"),
        (2, 0, "user", 0, None, 1, 0, ""),
    ], key=str)
    empty = spark.createDataFrame([], SCHEMA)
    assert link_quotations(empty).collect() == []


@pytest.mark.parametrize("n", [200])
def test_long_conversations_are_looked_up_across_stretches(spark, n):
    rows = [(1, i, "user", f"line {i}\nok") for i in range(n)] + [(1, n + i, "user", f"> line {i}\n> ok\nre") for i in range(0, n, 30)]
    found = {r[1]: r for r in linked(spark, rows)}
    for i in range(0, n, 30):
        assert found[n + i][4] == n - 1  # of one line each, the later source
        assert found[n + i][6] == 2
    assert [found[t][3] for t in sorted(found)] == list(range(len(found)))


def test_replies_follow_the_quotes_and_not_the_turn_before(spark):
    talks = read_table(spark, f"{DATA}/sf0.001", "conversations")
    found = link_quotations(as_mail(talks))
    told = found.join(talks.select("conv_id", "turn", answered(F.col("turn")).alias("meant")), ["conv_id", "turn"])
    away = told.where("meant >= 0 and reply_to <> turn - 1").count()
    assert away > 0.3 * talks.count()
    assert told.where("meant >= 0 and n_quoted = 0").isEmpty() and talks.where("text like '%>%'").isEmpty()
