from reelmill.session import build_session, with_defaults


def test_a_running_session_keeps_its_settings(spark):
    before = dict(spark.conf.getAll)
    same = build_session("other")
    assert same.sparkContext is spark.sparkContext
    assert dict(spark.conf.getAll) == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def test_defaults_fill_in_only_what_is_not_set(spark):
    """As for a new application: the tests' own settings win, the others are added."""
    fresh = spark.newSession()
    fresh.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    with_defaults(fresh)
    assert fresh.conf.get("spark.sql.shuffle.partitions") == "4"
    assert fresh.conf.get("spark.sql.session.timeZone") == "UTC"
    assert fresh.conf.get("spark.sql.ansi.enabled") == "true"
