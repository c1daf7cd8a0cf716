import pytest

from tidewater import session


def test_no_machine_local_folder_on_a_cluster():
    for master in ("spark://host:7077", "yarn", "k8s://https://host", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            session.local_scratch(master)


def test_settings_of_the_caller_stay(spark):
    before = spark.conf.get("spark.sql.adaptive.skewJoin.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
        session.configure(spark)
        assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "false"
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", before)
