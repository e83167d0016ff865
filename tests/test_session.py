from casemart.session import SETTINGS, shuffle_partitions_for


def test_partitions_grow_with_the_input():
    assert shuffle_partitions_for(10 << 20) == 200
    assert shuffle_partitions_for(100 << 40) == 102_400


def test_session_carries_the_settings(spark):
    assert {k: spark.conf.get(k) for k in SETTINGS} == SETTINGS
