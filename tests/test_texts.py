"""Rules about third-party text, and cards to forecast, on a few rows each."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from boutlens.functions import scalars
from boutlens.operators import cards, coverage


def values(spark, column, **cells):
    df = spark.createDataFrame([tuple(cells.values())], ", ".join(f"{k} {'array<string>' if isinstance(v, list) else 'string'}" for k, v in cells.items()))
    return df.select(column(df).alias("x")).first().x


@pytest.mark.parametrize("method,group", [("KO/TKO", "KO/TKO"), ("tko", "KO/TKO"), ("SUB", "Submission"), ("Submission (choke)", "Submission"), ("UD", "Decision"), ("sd", "Decision"), ("M-DEC", "Decision"),
                                          ("Decision - Split", "Decision"), ("DQ", "DQ"), ("Other", "Other"), ("Overturned", None), ("Could Not Continue", None), ("", None), (None, None)])
def test_method_groups(spark, method, group):
    assert values(spark, lambda df: scalars.method_group(df.m), m=method) == group


def test_market_wording_goes_also_across_segments(spark):
    said = ["62% of fans pick him.", "He is the underdog in the gym.", "I like 55 percent", "of what the public sees.", "Odds moved. He wrestles.", "He wins on the feet."]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(said)], "id int, pos int, text string")
    got = {r.pos: r.text for r in coverage.without_market_language(df, ["id"]).collect()}
    assert got == {}  # each stands beside a percentage, the odds or the fans
    apart = spark.createDataFrame([(i, 0, t) for i, t in enumerate(said)], df.schema)
    assert {r.id: r.text for r in coverage.without_market_language(apart, ["id"]).collect()} == {1: said[1], 2: said[2], 3: said[3], 5: said[5]}
    mixed = spark.createDataFrame([("The odds moved. He wrestles.",)], "t string")
    assert mixed.select(coverage.analyst_text(F.col("t"))).first()[0] == "He wrestles."


def test_comments_need_reasons_about_both_sides(spark):
    body = "I think Ann Alpha takes this because her wrestling and cardio are better than what Bea Beta has shown so far in " + "every round " * 5
    at = dt.datetime(2024, 1, 1)
    rows = [(1, "t", "u", 5, False, at, None, body), (2, "t", "u", 9, False, at, None, body), (3, "t", "[deleted]", 9, False, at, None, body), (4, "t", "v", 9, True, at, None, body),
            (5, "t", "w", 9, False, at, dt.datetime(2024, 2, 1), body), (6, "t", "x", 9, False, at, None, body.replace("Beta", "Gamma")), (7, "t", "y", 9, False, at, None, body.replace("because", "and")),
            (8, "t", "z", 9, False, at, None, body.replace("wrestling and cardio", "heart and will")), (9, "t", "q", 1, False, at, None, body), (10, "t", "r", 4, False, at, None, body)]
    df = spark.createDataFrame(rows, "comment_id int, thread string, author string, score int, stickied boolean, created timestamp, edited timestamp, body string")
    df = df.withColumns({"a_terms": F.array(F.lit("ann alpha"), F.lit("alpha")), "b_terms": F.array(F.lit("bea beta"), F.lit("beta")), "weight": F.when(F.col("author") == "r", 0.9).otherwise(0.2)})
    assert sorted(r.comment_id for r in coverage.reasoned_comments(df, "2024-01-15").collect()) == [1, 2, 10]
    entry = coverage.comment_entries(df, "2024-01-15").collect()
    assert [(r.source_id, r.content_id) for r in entry] == [("reddit:u", "reddit:2")]


def test_segments_are_whole_and_bad_transcripts_refused(spark):
    rows = [(1, 0, "<i>a &amp; b</i>", 0.0, 1.0), (1, 1, "a & b", 1.0, 1.0), (1, 2, " ", 2.0, 1.0), (1, 3, "x" * 9000, 3.0, 1.0), (2, 0, "fine", 0.0, 1.0), (2, 1, "bad", -1.0, 1.0), (3, 0, " ", 0.0, 0.0)]
    df = spark.createDataFrame(rows, "id int, pos int, text string, start double, duration double")
    got = [(r.id, r.pos, len(r.text)) for r in coverage.normalised_segments(df, ["id"]).orderBy("id", "pos").collect()]
    assert got == [(1, 0, 5), (1, 3, 9000)]
    assert {r.id: r.problem for r in coverage.segment_problems(df, ["id"]).collect()} == {2: "timing", 3: "empty"}


def test_titles_labels_and_previews(spark):
    pair = lambda text: values(spark, lambda df: scalars.paired_title(df.t, df.a, df.b), t=text, a="alpha", b="beta")
    assert pair("alpha vs beta preview") and pair("beta alpha picks") and pair("x alpha x beta") and not pair("alpha then beta") and not pair("alphabet vs beta")
    assert values(spark, lambda df: scalars.fighter_terms(df.n, df.al), n="Ann Lee Alpha", al=["The Fox"]) == ["Ann Lee Alpha", "Alpha", "The Fox"]
    assert values(spark, lambda df: scalars.fighter_terms(df.n), n="Ann Lee") == ["Ann Lee"]
    assert values(spark, lambda df: scalars.event_labels(df.e), e="UFC 300: Alpha vs Beta") == ["UFC 300: Alpha vs Beta", "Alpha vs Beta", "UFC 300"]
    assert values(spark, lambda df: scalars.event_labels(df.e), e="Gala: Alpha vs Beta") == ["Gala: Alpha vs Beta", "Alpha vs Beta"]
    named = lambda text: values(spark, lambda df: scalars.event_matches(df.t, df.w, F.array(F.array(F.lit("alpha"), F.lit("beta")), F.lit(None), F.lit(None))), t=text, w=["alpha vs beta", "ufc 300", "ufc"])
    assert named("our ufc 300 picks") and named("beta v alpha") and not named("ufc news")
    assert values(spark, lambda df: scalars.card_preview(df.t), t="ufc full card predictions") and not values(spark, lambda df: scalars.card_preview(df.t), t="predictions for monday")


def test_both_sides_near_each_other(spark):
    near = lambda t, a=("alpha",), b=("beta",): values(spark, lambda df: coverage.matchup_discussed(df.t, df.a, df.b, 30), t=t, a=list(a), b=list(b))
    assert near("alpha meets beta") and not near("alpha " + "x " * 30 + "beta") and near("alpha " + "x " * 30 + "beta and alpha")
    assert not near("lee and lee", ("lee",), ("lee",)) and near("lee ann and lee bea", ("lee", "ann"), ("lee", "bea")) and not near("alpha alpha alpha")


def test_explicit_picks(spark):
    def pick(evidence, who="Ann Alpha"):
        df = spark.createDataFrame([(who, evidence)], "p string, e string")
        df = df.withColumns({"ew": scalars.words(F.col("e")), "tw": scalars.words(F.concat(F.lit("well "), "e"))})
        names, lower = F.array(F.lit("Ann Alpha"), F.lit("Alpha")), F.array(F.lit("ann alpha"), F.lit("alpha"))
        sides = F.array(F.lit("Ann Alpha"), F.lit("Bea Beta"))
        return df.select(coverage.explicit_pick(df.p, df.e, df.ew, df.tw, sides, names, lower).alias("x")).first().x

    assert pick("My pick is Alpha.") and pick("I'm picking Ann Alpha") and pick("Alpha by decision") and pick("Ann Alpha will win")
    assert not pick("Alpha might win: my pick is Alpha") and not pick("Alpha's wrestling is my pick Alpha's") and not pick("He said my pick is Alpha")
    assert not pick("Alpha looks great") and not pick("My pick is Alpha at these odds") and not pick("My pick is Gamma", "Gamma") and not pick("")


def test_quotes_are_found_and_redacted(spark):
    protected = spark.createDataFrame([("a b c d e f g h i j",), ("short one here",), ("no go",)], "text_words string")
    outputs = spark.createDataFrame([(1, "x b c d e f g h i y"), (2, "x b c d e f g y"), (3, "that short one here too"), (4, "no go")], "id int, text_words string")
    grams = coverage.protected_grams(protected)
    found = coverage.quotes(outputs, grams, "id")
    assert {r.id: r.quotes for r in found.collect()} == {1: 1, 3: 1}
    texts = coverage.redacted(outputs.withColumn("text", F.col("text_words")), found, "id").orderBy("id").collect()
    assert [r.text.startswith("[Quotation") for r in texts] == [True, False, True, False]


def test_coverage_of_a_contest(spark):
    day = dt.date(2024, 1, 20)
    contest = spark.createDataFrame([(1, 9, day, ["ann alpha"], ["bea beta"], "alpha", "beta", ["gala night"], [None], ["ann alpha", "alpha", "bea beta", "beta"])],
                                    "fight_id int, event_id int, event_date date, a_words array<string>, b_words array<string>, a_surname string, b_surname string, label_words array<string>, label_pairs array<array<string>>, terms array<string>")
    at = dt.datetime(2024, 1, 15)
    texts = [("t1", "alpha vs beta", "alpha vs beta", at), ("t2", "gala night", "gala night talk", at), ("t3", "results", "alpha vs beta results", at), ("t4", "mma full card picks", "mma full card picks", at), ("t5", "alpha vs beta", "alpha vs beta", dt.datetime(2024, 1, 21))]
    df = spark.createDataFrame(texts, "text_id string, title_words string, text_words string, published_at timestamp")
    df = df.withColumns({"observed_at": F.col("published_at"), "fetched_at": F.col("published_at"), "published_date": F.col("published_at").cast("date")})
    segments = [(t, i, w, float(i)) for t in ("t1", "t2", "t4") for i, w in enumerate(["hello there", "ann", "alpha is here", "bye"] if t == "t2" else ["one", "two"])]
    lines = spark.createDataFrame(segments, "text_id string, pos int, text string, start double").withColumn("text_words", F.col("text"))
    described = spark.createDataFrame([("t2", "0:00 Intro\n0:02 Alpha talk\n0:03 End")], "text_id string, description string")
    sources, read = coverage.coverage_for(contest, df, lines, described, "2024-01-20")
    assert {r.text_id: (r.match, r.caveat) for r in sources.collect()} == {"t1": ("contest", None), "t2": ("card", "selected or cut passages"), "t4": ("provisional", "no discussion found")}
    assert sorted((r.text_id, r.pos) for r in read.collect()) == [("t1", 0), ("t1", 1), ("t2", 2)]
    _, read = coverage.coverage_for(contest, df, lines, described.limit(0), "2024-01-20", budget=15)
    assert sorted((r.text_id, r.text) for r in read.collect()) == sorted([("t1", "one"), ("t1", "two"), ("t2", "hello there"), ("t2", "ann"), ("t2", "a")])


def test_cards_to_forecast(spark):
    rows = [("c", 1, 1, "win", None, False), ("c", 2, 2, None, None, True), ("c", 3, 3, None, "", False), ("d", 4, 1, None, "KO/TKO", False), ("e", 5, 1, None, None, True), ("e", 5, 2, None, None, True)]
    card = spark.createDataFrame(rows, "event_id string, fight_id int, position int, result string, method_of_victory string, matchup_link boolean")
    assert sorted((r.fight_id, r.state) for r in cards.remaining_contests(card).collect()) == [(1, "completed"), (2, "remaining"), (3, "unclear"), (4, "completed"), (5, "unclear"), (5, "unclear")]
    listing = spark.createDataFrame([("c", dt.date(2024, 1, 5)), ("d", dt.date(2024, 1, 6)), ("e", dt.date(2024, 1, 1))], "event_id string, event_date date")
    assert {r.event_id: r.status for r in cards.deferred_cards(listing, card, "2024-01-05").collect()} == {"c": "deferred", "d": "error", "e": "take"}
    pairs = spark.createDataFrame([(1, "Ann", "Bea"), (2, "Cat", "Ann")], "fight_id int, fighter_a_name string, fighter_b_name string")
    kept, asked = cards.exclude_contests(pairs, spark.createDataFrame([("bea ",), ("ANN",), ("9",), ("2",)], "request string"))
    assert kept.count() == 0 and {r.request: r.matches for r in asked.collect()} == {"bea ": 1, "ANN": 2, "9": 0, "2": 1}
    fights = spark.createDataFrame([(1, 10, 11), (2, 12, 13)], "fight_id int, fighter_a_id int, fighter_b_id int")
    assert {r.fight_id: r.still for r in cards.still_remaining(fights, fights.withColumn("fighter_b_id", F.when(F.col("fight_id") == 1, 11).otherwise(14))).collect()} == {1: True, 2: False}
    head = spark.createDataFrame([("c", dt.date(2024, 1, 5), 3, dt.datetime(2024, 1, 1))], "event_id string, event_date date, source_fight_count int, last_scraped_at timestamp")
    bouts = spark.createDataFrame([("c", 1, None, False), ("c", 2, 3, True), ("c", 3, None, False)], "event_id string, card_order int, scheduled_rounds int, is_title_bout boolean")
    got = cards.card_features(head, bouts, "2024-01-05", "2024-01-05").orderBy("card_order").collect()
    assert [r.scheduled_rounds for r in got] == [5, 3, 3] and got[0].caveats == ["stale schedule", "card is today"] and got[1].rounds_basis == "source"
    assert cards.card_features(head, bouts.limit(2), "2024-01-05", "2024-01-05").count() == 0


def test_published_gate_and_replay(spark):
    every = dict.fromkeys(cards.CHECKS, True)
    rows = [(1, "x", None, None, None), (2, None, "deterministic", "validated", every), (3, None, "deterministic", "validated", {**every, "schema": False}), (4, None, "review", "approved", {"a": True}), (5, None, "review", "approved", {"a": True, "b": None}), (6, None, None, None, None)]
    df = spark.createDataFrame(rows, "id int, error string, mode string, review_status string, checks map<string, boolean>")
    assert {r.id: r.published for r in cards.published_gate(df).collect()} == {1: True, 2: True, 3: False, 4: True, 5: False, 6: False}
    names = spark.createDataFrame([(1, "A"), (2, "B"), (3, "C"), (4, "C")], "fighter_id int, fighter_name string")
    report = spark.createDataFrame([("A", "B", 3, "A"), ("A", "C", 3, "A"), ("A", "B", None, "B")], "fighter_a string, fighter_b string, scheduled_rounds int, predicted_winner string")
    jobs = cards.replay_cohort(report, names)
    assert "predicted_winner" not in jobs.columns and [r.problem for r in jobs.orderBy("fighter_b", F.col("scheduled_rounds").desc()).collect()] == [None, "distance not recorded", "ambiguous identity"]
    urls = spark.createDataFrame([("c", "u1", 1), ("c", "u2", 2), ("d", "u3", 3), ("d", "u4", 3)], "event_id string, fight_url string, fight_id int")
    found = {(r.event_id, r.problem) for r in cards.identity_sets(urls, urls.filter("fight_url != 'u2'")).collect()}
    assert found == {("c", "summary missing"), ("d", "card repeats a url or an id"), ("d", "summary repeats a url or an id")}
    assert cards.public_projection(names.withColumnRenamed("fighter_name", "event_name").withColumn("odds", F.lit(1))).columns == ["event_name"]
