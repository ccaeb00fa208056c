import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{shared}").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def tracks(spark):
    """Tracks from (name, chrom, strand, exons, gene, score)."""
    schema = "name string, chrom string, strand string, tx_start long, tx_end long, exons array<struct<start:long,end:long>>, gene_id string, score int, instance_id long"

    def make(*rows):
        full = [(n, c, s, x[0][0], x[-1][1], x, g, score, k) for k, (n, c, s, x, g, score) in enumerate(rows)]
        return spark.createDataFrame(full, schema)

    return make
