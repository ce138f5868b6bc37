"""The warehouse refresh writes every table with its declared schema."""

import os
import tempfile

from kalulu.plans.refresh import LOADERS, refresh_warehouse
from kalulu.sources.fixtures import Warehouse
from kalulu.sources.schema import struct_type

SF = "/root/testdata/sf0.001"


def test_refresh_writes_declared_tables(spark):
    wh = Warehouse(spark, SF)
    target = tempfile.mkdtemp(prefix="kalulu-refresh-", dir=os.environ.get("TMPDIR", "/tmp"))
    paths = refresh_warehouse(wh, target)
    assert set(paths) == set(LOADERS)
    for name, path in paths.items():
        back = spark.read.parquet(path)
        assert [f.name for f in back.schema.fields] == [f.name for f in struct_type(name).fields]
        assert [f.dataType for f in back.schema.fields] == [f.dataType for f in struct_type(name).fields]
    for name in ["mw_art_followup", "mw_art_viral_load", "mw_eid_register", "mw_patient"]:
        assert spark.read.parquet(paths[name]).count() == LOADERS[name](wh).count()
