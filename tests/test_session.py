from checks.scratch import fresh_folder
from sluiceway import session
from sluiceway.session import ObjectStore, kafka_package, session_settings


def test_plain_settings():
    settings = session_settings()
    assert settings["spark.sql.session.timeZone"] == "UTC"
    assert not any("delta" in value.lower() or "s3a" in key for key, value in settings.items())
    assert "spark.jars.packages" not in settings


def test_lake_settings():
    store = ObjectStore("http://store:9000", "key", "word", tls=False)
    settings = session_settings(
        delta=True, store=store, metastore_uri="thrift://meta:9083", packages=("a:b:1", kafka_package()),
        extra={"spark.sql.session.timeZone": "Asia/Tokyo"},
    )
    assert settings["spark.sql.extensions"] == "io.delta.sql.DeltaSparkSessionExtension"
    assert settings["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert settings["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert settings["spark.hadoop.fs.s3a.access.key"] == "key"
    assert settings["spark.sql.catalogImplementation"] == "hive"
    assert settings["spark.jars.packages"].startswith("a:b:1,org.apache.spark:spark-sql-kafka-0-10_2.13:")
    assert settings["spark.sql.session.timeZone"] == "Asia/Tokyo"
    assert "word" not in repr(store) and "key" not in repr(store).replace("access_key", "")


def test_no_keys_no_provider():
    assert not any("key" in name or "provider" in name for name in ObjectStore("e").settings())


def test_scratch_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, other = fresh_folder(spark), fresh_folder(spark)
    assert one.startswith(shared) and other.startswith(shared) and one != other


def test_package_coordinates():
    assert session.s3a_package(session.hadoop_version()).startswith("org.apache.hadoop:hadoop-aws:3.")
    assert session.delta_package("9.9") == "io.delta:delta-spark_2.13:9.9"
    assert session.kafka_package().startswith("org.apache.spark:spark-sql-kafka-0-10_2.13:")
