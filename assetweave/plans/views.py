"""Deterministic projections of the test tables onto the engine's record types; the same text runs on Spark and DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from assetweave.session import fitted, written

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS = {
    "v_entities": "select o_orderkey entity_id, case o_orderkey % 5 when 0 then 'wearable' when 1 then 'emote' else 'scene' end type, o_custkey base, o_orderdate ts, o_orderstatus st from {orders}",
    "v_content": """select distinct l_orderkey entity_id, l_partkey pk, concat('h', cast(l_partkey as string)) hash,
        concat('models/', cast(l_partkey as string), case l_partkey % 4 when 0 then '.glb' when 1 then '.png' when 2 then '.bin' else '.json' end) file from {lineitem}""",
    "v_inventory": "select concat('h', cast(p_partkey as string)) hash from {part} where p_size <= 45",
    "v_cache": "select concat('h', cast(p_partkey as string)) hash from {part} where p_size <= 20",
    "v_manifests": "select o_orderkey entity_id, case o_orderstatus when 'F' then 0 when 'O' then 12 else null end exit_code, case when o_orderkey % 3 = 0 then 'v48' else 'v49' end version from {orders}",
    # Each entity also holds a texture and a buffer for its containers, now and then not; some paths are there twice, in other letter case.
    "v_scene": """select entity_id, cast(pk as bigint) pos, file, hash from {v_content}
        union all select distinct entity_id, 1000000000 + pk % 40, concat('models/Tex ', cast(pk % 40 as string), '.PNG'), concat('t', cast(pk % 40 as string), 'x', cast(entity_id % 3 as string)) from {v_content} where pk % 4 = 0 and (entity_id + pk % 40) % 20 <> 0
        union all select distinct entity_id, 2000000000 + pk % 24, concat('buffers/b', cast(pk % 24 as string), '.bin'), concat('b', cast(pk % 24 as string)) from {v_content} where pk % 4 = 0
        union all select distinct entity_id, 3000000000 + pk % 24, concat('Buffers/B', cast(pk % 24 as string), '.bin'), concat('B', cast(pk % 24 as string)) from {v_content} where pk % 4 = 0 and entity_id % 5 = 0""",
    # The JSON text of each container (<> for its braces), and its binary version: some are broken in one way or another.
    "v_containers": """select pk, hash, case when pk % 124 = 0 then 1 else 2 end version, translate(case when pk % 104 = 0 then 'null' when pk % 116 = 0 then '<"images":[' when pk % 148 = 0 then '<"images":[<"uri":"https://x.org/a.png">]>'
        when pk % 164 = 0 then '<"images":[<"uri":"a%2.png">]>' when pk % 172 = 0 then '<"buffers":[<"uri":"../../x.bin">]>' when pk % 16 = 0 then '<"asset":<"version":"2.0">>'
        else concat('<"images":[<"uri":"Tex%20', cast(pk % 40 as string), '.png">,<"uri":"./Tex%20', cast(pk % 40 as string), '.png">,<"uri":"data:image/png;base64,AA">,<"bufferView":0>,null],"buffers":[<"uri":"../buffers/b', cast(pk % 24 as string), '.bin">]>') end, '<>', concat(chr(123), chr(125))) doc
        from (select p_partkey pk, concat('h', cast(p_partkey as string)) hash from {part} where p_partkey % 4 = 0) p""",
    "v_thumbs": "select entity_id, concat('MODELS/', cast(min(pk) as string), '.PNG') thumb from {v_content} where pk % 4 = 1 group by entity_id having min(pk) % 3 = 0",
    # Manifests of each base's newest deployment; some are of another kind, broken, old, without a server or of an entity that is gone.
    "v_backfill": """select entity_id, case entity_id % 23 when 0 then 'sentinel' when 1 then 'mac' when 2 then 'broken' when 3 then 'version' when 4 then 'exit' when 5 then 'nolist' when 6 then 'noserver' when 7 then 'gone' else 'good' end kind
        from (select o_orderkey entity_id, row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) n from {orders}) o where n = 1""",
    "v_listed": """select entity_id, 'AssetBundles' file from {v_backfill} union all select c.entity_id, concat(c.hash, v.v) from {v_content} c join {v_backfill} b on b.entity_id = c.entity_id
        join (select '_windows' v, 0 m union all select '_windows.br', 1 union all select '_d_windows', 2 union all select 'z_windows', 3 union all select '_mac', 4) v on v.m = 0 or c.pk % 5 = v.m where c.pk % 4 in (0, 1)""",
    "v_jobs": "select event_id job_id, ts, user_id entity_id, event_type = 'error' lods, event_type = 'signup' force, event_type = 'purchase' iss, event_type, value from {events}",
    "v_bundles": """select concat('h', cast(p_partkey as string), case p_size % 3 when 0 then '_windows' when 1 then '_mac' else '_windows.br' end) bundle, p_partkey pk, p_brand, p_size,
        concat('Qm', cast(p_partkey as string), case p_partkey % 2 when 0 then 'Ab' else 'xY' end) cid from {part}""",
}


class Views:
    """The tables and projections over one folder of Parquet tables, made when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.made = spark, folder, {}

    def __getattr__(self, name: str) -> DataFrame:
        made = self.__dict__["made"]
        if name not in made:
            if name in TABLES:
                path = f"{self.folder}/{name}.parquet"
                fitted(self.spark, path)
                made[name] = self.spark.read.parquet(path)
            elif name in VIEWS:
                made[name] = self.sql(VIEWS[name])
            else:
                raise AttributeError(name)
        return made[name]

    def stored(self, name: str) -> DataFrame:
        """A projection as a table in the shared folder, written once for all that read it."""
        made = self.__dict__["made"]
        if f"stored {name}" not in made:
            made[f"stored {name}"] = written(getattr(self, name), name)
        return made[f"stored {name}"]

    def of(self, entities: DataFrame) -> Views:
        """The same projections over the lines of these entities only (entity_id)."""
        some = Views(self.spark, self.folder)
        some.made["lineitem"] = self.lineitem.join(entities.selectExpr("entity_id l_orderkey"), "l_orderkey", "left_semi")
        return some

    def sql(self, text: str) -> DataFrame:
        return self.spark.sql(text, **{n: getattr(self, n) for n in set(re.findall(r"\{(\w+)\}", text))})


def duck(text: str) -> str:
    """``text`` for DuckDB, with the projections that it names as common table expressions."""
    need: list[str] = []

    def visit(t: str) -> None:
        for n in re.findall(r"\{(\w+)\}", t):
            if n in VIEWS and n not in need:
                visit(VIEWS[n])
                need.append(n)

    visit(text)
    plain = lambda t: re.sub(r"\{(\w+)\}", r"\1", t)
    return "with " + ", ".join(f"{n} as ({plain(VIEWS[n])})" for n in need) + " " + plain(text) if need else plain(text)
