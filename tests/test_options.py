import pytest

from changelake.operators import control
from changelake.sources import options


def test_pinned_options_stay():
    assert options.checked({"poll": "5"})["lsn.flush.mode"] == "connector"
    with pytest.raises(options.UnsafeOption):
        options.checked({"provide.transaction.metadata": "false"})
    with pytest.raises(options.UnsafeOption):
        options.no_collision("app", ["public.t", "transaction"])
    options.no_collision("app", ["public.t"])
    with pytest.raises(options.UnsafeOption):
        options.policy("drop")


def test_unknown_notifications_fail(spark):
    with pytest.raises(Exception, match="unknown notification"):
        control.notification(spark.createDataFrame([(1, '{"observation": "ODD"}')], "seq long, value string")).collect()
