import random

import pytest
from pyspark.sql import functions as F

from leadloom import Params
from leadloom.functions.qualification import SIGNALS, score_candidates
from leadloom.operators.expansion import expand_queries, niche_frame
from leadloom.operators.order import circular_batch, with_position
from leadloom.schemas import candidates_from

P = Params(as_of="2026-08-17T12:00:00+00:00")


def scored(spark, **values):
    df = spark.range(1)
    given = {k: F.lit(v) for k, v in values.items()}
    return score_candidates(candidates_from(df, ord=F.col("id"), source=F.lit("YOUTUBE"), platform=F.lit("YouTube"), **given), P).first()


def test_example(spark):
    row = scored(spark, provider_id="UC1", name="Business Coach", website="https://creator.com", niche="business", country="FR", language="fr",
                 followers=12000, published_at=P.as_of, description="Business coach face cam tips and educational shorts", raw_text="coach conseils captions shorts")
    assert row.score == 100 and row.classification == "HOT" and row.content_type == "talking_head" and row.caption_opportunity == "GOOD"
    assert row.why_qualified == "target niche, content fit, audience fit, recent activity, caption opportunity"


def test_nothing_known(spark):
    row = scored(spark)
    assert row.score == 3 and row.classification == "LOW" and row.why_qualified == "limited public qualification signals"
    assert row.content_type == row.caption_opportunity == "UNKNOWN"


def test_branches(spark):
    short = scored(spark, raw_text="a reel", content_type="vlog", followers=-3, language="FR", country="be")
    assert (short.caption_opportunity, short.signals.caption_opportunity, short.signals.content_fit) == ("DECENT", 7, 5)
    assert (short.signals.audience_fit, short.signals.target_language, short.signals.target_country) == (None, 10, 8)
    assert scored(spark, followers=3).signals.audience_fit == 4
    # the name counts for the content type but not for the short-form and caption words
    assert scored(spark, name="captions").caption_opportunity == "UNKNOWN"
    assert scored(spark, niche="real estate tours").signals.target_niche == 18
    assert set(SIGNALS) == set(scored(spark).signals.asDict())


def test_ties_keep_signal_order(spark):
    row = scored(spark, country="FR", raw_text="consultant")
    assert row.why_qualified == "target country, commercial creator"


def test_queries(spark):
    params = Params(as_of=P.as_of, target_languages=("fr",), creator_types=("coach",))
    queries = with_position(expand_queries(niche_frame(spark, ("fitness",)), params), [F.col("query_ord")])
    texts = [r.query for r in queries.orderBy("pos").collect()]
    assert texts[:4] == ["coach fitness", "coach fitness français", "personal trainer", "personal trainer français"]
    # "coach fitness" again from creator type and niche is the same query
    assert len(texts) == len({t.lower() for t in texts}) == 14
    batch, following = circular_batch(queries, 0, 3)
    assert batch.count() == 3 and following == 3
    other = expand_queries(niche_frame(spark, ("slow_food",)), Params(as_of=P.as_of, target_languages=("xx", "en", "nl")))
    assert [r.query for r in other.orderBy("query_ord").collect()] == ["slow food", "slow food english", "coach slow food", "consultant slow food", "formateur slow food"]


def test_params():
    assert Params.hourly().target_leads == 500
    for wrong in (dict(min_score=101), dict(hot_score=-1), dict(min_subscribers=5, max_subscribers=4), dict(max_pages_per_domain=-1), dict(as_of="soon")):
        with pytest.raises(ValueError):
            Params(**wrong)
