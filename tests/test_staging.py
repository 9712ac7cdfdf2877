from annolink import staging


class Context:
    def __init__(self, master, folder=None):
        self.master, self.folder, self.applicationId = master, folder, f"app-{id(self)}"

    def getCheckpointDir(self):
        return self.folder


class Session:
    def __init__(self, master, setting=None, folder=None):
        self.sparkContext = Context(master, folder)
        self.setting = setting
        self.conf = self

    def get(self, key, default=None):
        return "hdfs://warehouse" if "warehouse" in key else self.setting or default


def test_the_clusters_folder_is_used():
    assert staging.staging_folder(Session("yarn", "hdfs://x/checkpoints")) == "hdfs://x/checkpoints"
    assert staging.staging_folder(Session("yarn", None, "hdfs://y")) == "hdfs://y"


def test_without_a_setting_the_warehouse_is_used():
    assert staging.staging_folder(Session("local[4]")) == "hdfs://warehouse/_staged"


def test_stage_keeps_rows_and_schema(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    staged = staging.stage(df)
    assert staged.schema == df.schema and rows(staged) == rows(df)
    assert "LogicalRDD" not in staged._jdf.queryExecution().toString()
