"""Generated methods stay below what the JVM compiles where listings are read, unless the session names a limit."""

from listing_yield import session
from listing_yield.plans import queries


def test_limit_is_set_by_the_listings(spark, monkeypatch):
    monkeypatch.setattr(queries, "input_identity", lambda *args: "key")
    monkeypatch.setitem(queries._LISTINGS, "key", "rows")
    other, own = spark.newSession(), spark.newSession()
    session.ship_package(other)
    assert other.conf.get(session.HUGE_METHOD, None) is None
    assert queries._numbered(other, "folder") == "rows"
    assert other.conf.get(session.HUGE_METHOD) == session.HUGE_METHOD_BYTES
    own.conf.set(session.HUGE_METHOD, "20000")
    queries._numbered(own, "folder")
    assert own.conf.get(session.HUGE_METHOD) == "20000"
