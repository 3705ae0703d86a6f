"""Views of the test tables in the shapes the operators take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rigstream.functions.text import epoch_millis
from rigstream.operators.decode import computed_once
from rigstream.sources.messages import spread

RIG_TIE = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ms", epoch_millis(F.col("ts")))


def _text(name: str) -> Column:
    return F.col(name).cast("string")


def tank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        _text("user_id").alias("tankId"), F.col("ms").alias("ts"), F.col("value").alias("waterTankLevel")
    )


def wind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        F.col("event_type").alias("geoZone"), F.col("ms").alias("ts"), F.col("value").alias("windSpeed")
    )


def rpm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        _text("user_id").alias("id"), _text("ms").alias("ts"), F.col("value").alias("currentRpm")
    )


def torque(spark: SparkSession, sf_dir: str) -> DataFrame:
    load = F.col("value") + F.col("event_id") % 7
    return _events(spark, sf_dir).select(_text("user_id").alias("id"), _text("ms").alias("ts"), load.alias("currentTorque"))


def block(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        _text("user_id").alias("id"), F.col("ms").alias("ts"), F.col("value").alias("blockPosition")
    )


def rig(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    number, flag = F.col("l_linenumber"), F.col("l_returnflag")
    depth = F.lit(25) + F.col("l_quantity") / 10
    lost = (number == 6) & (flag == "A")
    return lines.select(
        _text("l_suppkey").alias("id"),
        epoch_millis(F.col("l_shipdate")).alias("ts"),
        *RIG_TIE,
        F.when(lost, -999.25).when((number == 6) & (flag == "R"), 0.0).otherwise(depth).alias("bitDepth"),
        F.when(lost, -999.25).when(number <= 2, depth + 0.1).otherwise(60.0).alias("holeDepth"),
        F.when(F.col("l_tax") < 0.04, 0.0).otherwise(F.col("l_tax")).alias("totalPumpOutput"),
        (F.col("l_discount") * 50).alias("rotaryRpm"),
        F.when(number == 5, 1).otherwise(0).alias("inSlipStatus"),
        F.when(F.col("l_tax") >= 0.05, 3447380.0).otherwise(0.0).alias("standpipePressure"),
    )


def _packed(df: DataFrame, fields: dict[str, Column], **keep: Column) -> DataFrame:
    rows = spread(df.select(*[c.alias(f"_{name}") for name, c in fields.items()], *[c.alias(n) for n, c in keep.items()]))
    text = F.to_json(F.struct(*[F.col(f"_{name}").alias(name) for name in fields]))
    return computed_once(rows, "value", text).select(*keep, "value")


def _whole(name: str) -> Column:
    return F.col(name).cast("bigint").cast("string")


def witsml_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {
        "nameWell": F.concat(F.lit("W"), "l_suppkey"),
        "nameWellbore": F.concat(F.lit("WB"), F.col("l_partkey") % 3),
        "LogName": F.concat(F.lit("Log "), "l_returnflag"),
        "tsds": _text("l_orderkey"),
        "hint": F.lit("DEPTHLOG"),
        "ROP": _whole("l_quantity"),
        "WOB": _text("l_linenumber"),
        "GR": F.col("l_linestatus"),
    }
    return _packed(table(spark, sf_dir, "lineitem"), fields, seq=F.col("l_partkey"))


def witsml_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = {
        "nameWell": F.concat(F.lit("W"), "user_id"),
        "nameWellbore": F.lit("WB1"),
        "LogName": F.lit("Log 1"),
        "tsds": _text("ms"),
        "hint": F.lit("TIMELOG"),
        "K": F.get_json_object("props", "$.k"),
    }
    pairs = [part for name, c in shared.items() for part in (F.lit(name), c)]
    record = F.create_map(*pairs, F.col("event_type"), _text("value"))
    return _events(spark, sf_dir).select(F.col("event_id").alias("seq"), F.to_json(record).alias("value"))


def witsml_message(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = {
        "nameWell": F.concat(F.lit("W"), "conv_id"),
        "nameWellbore": F.lit("WB1"),
        "LogName": F.when(F.col("turn") % 2 == 0, "").otherwise(F.concat(F.lit("Log #"), "role")),
        "tsds": (F.col("turn") * 1000).cast("string"),
        "hint": F.lit("MESSAGELOG"),
        "Message": F.col("text"),
    }
    return _packed(table(spark, sf_dir, "conversations"), fields)


def witsml_mse(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, line = F.col("l_partkey"), F.col("l_linenumber")
    fields = {
        "nameWell": F.concat(F.lit("W"), "l_suppkey"),
        "nameWellbore": F.lit("WB1"),
        "LogName": F.concat(F.lit("Log "), "l_returnflag"),
        "tsds": _text("l_orderkey"),
        "TOR": _whole("l_quantity"),
        "RPM": F.when(part % 11 != 0, (60 + line).cast("string")),
        "ROP": F.when(part % 13 == 0, "0").when(part % 17 == 0, "-9999").otherwise((10 + line).cast("string")),
        "WOB": F.when(part % 19 == 0, "n/a").otherwise((line * 100).cast("string")),
        "diameter": F.when(part % 23 != 0, "8"),
        "diameterLogA": F.when(F.col("l_returnflag") == "A", "6"),
    }
    return _packed(table(spark, sf_dir, "lineitem"), fields, l_orderkey=F.col("l_orderkey"), l_linenumber=line)


def witsml_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, key = F.col("p_size"), F.col("p_partkey")
    fields = {
        "nameWell": F.col("p_brand"),
        "nameWellbore": F.concat(F.lit("WB"), size % 3),
        "nameTrajectory": F.col("p_type"),
        "nameTrajectoryStn": F.concat(F.lit("Stn"), key),
        "mdValue": size.cast("string"),
        "mdUom": F.lit("m"),
        "tvdValue": F.when(size % 5 == 0, "").otherwise((size * 2).cast("string")),
        "inclValue": F.when(size % 7 != 0, (size + 1).cast("string")),
        "dispNsVertSecOrigValue": key.cast("string"),
        "dispEwVertSecOrigValue": (key + 1).cast("string"),
    }
    return _packed(table(spark, sf_dir, "part"), fields)


def attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    fields = {
        "nameWell": F.col("c_name"),
        "nameWellbore": F.when(key % 4 == 0, "").otherwise(F.concat(F.lit("WB"), key % 3)),
        "nameRig": F.when(key % 5 == 0, "").otherwise(F.col("c_mktsegment")),
        "timeZone": F.when(key % 6 == 0, "").otherwise("UTC"),
        "statusWell": F.when(key % 7 != 0, "active"),
        "country": _text("c_nationkey"),
    }
    return _packed(table(spark, sf_dir, "customer"), fields, seq=key)


def _tag(key: Column, value: Column) -> Column:
    ds = (F.col("event_id") % 1000) / 2
    return F.struct(key.alias("key"), value.alias("value"), F.col("ms").alias("ts"), ds.alias("ds"))


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw telemetry envelopes with four tags each, of up to three logs."""
    event, user, kind = F.col("event_id"), F.col("user_id"), F.col("event_type")
    device_type = F.when(user % 3 == 0, "WaterTank").when(user % 3 == 1, "DrillBit").otherwise("default")
    channel = F.when(user % 3 == 0, "waterTankLevel").when(user % 3 == 1, "currentRpm").otherwise("blockPosition")
    own_key = (
        F.when(kind == "error", "Message@Log #err")
        .when(kind == "signup", "Traj1")
        .when(kind == "purchase", "ROP@Log A")
        .otherwise(F.concat(kind, F.lit("@Log B")))
    )
    return _events(spark, sf_dir).select(
        event,
        F.when(event % 4 == 0, "POST_TELEMETRY")
        .when(event % 4 == 1, "POST_TELEMETRY_DEPTH")
        .when(event % 4 == 2, "POST_ATTRIBUTES")
        .otherwise("GET_ATTRIBUTES")
        .alias("msgType"),
        F.concat(F.lit("dev"), user).alias("deviceName"),
        device_type.alias("deviceType"),
        F.create_map(
            F.lit("nameWell"), F.concat(F.lit("W"), user), F.lit("nameWellbore"), F.lit("WB1"),
            F.lit("deviceType"), device_type, F.lit("tankId"), F.when(user % 2 == 0, user.cast("string")),
        ).alias("cs"),
        F.create_map(
            F.lit("id"), F.concat(F.lit("bit"), user), F.lit("deviceName"), F.concat(F.lit("dev"), user),
            F.lit("diameter"), F.when(user % 5 == 0, "").otherwise("8"),
        ).alias("ss"),
        F.array(
            _tag(own_key, _text("value")),
            _tag(F.lit("WOB@Log A"), (event % 50).cast("string")),
            _tag(F.lit("TOR@Log A"), (event % 30).cast("string")),
            _tag(channel, _text("value")),
        ).alias("tags"),
    )


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event_id")
    record = F.concat(
        F.lit('{"id":"'), "user_id", F.lit('","ts":"'), "ms", F.lit('","blockPosition":'), _text("value"), F.lit("}")
    )
    text = (
        F.when(event % 6 == 0, "")
        .when(event % 6 == 1, "   ")
        .when(event % 6 == 2, '{"id":1,')
        .when(event % 6 == 3, "[1]")
        .when(event % 6 == 4, "{}")
        .otherwise(record)
    )
    return _events(spark, sf_dir).select(event, text.alias("value"))


def _sensor(spark: SparkSession, sf_dir: str, fields: dict[str, Column], value: str) -> DataFrame:
    """Sensor messages; of some the value is quoted, of some it is no number, some lack it, and some are blank."""
    event, reading = F.col("event_id"), _text("value")
    quoted = {**fields, value: F.when(event % 13 == 0, "broken").when(event % 17 != 0, reading)}
    bare = {**fields, value: F.when(event % 17 != 0, F.col("value"))}
    as_json = [F.to_json(F.struct(*[c.alias(n) for n, c in made.items()])) for made in (quoted, bare)]
    text = F.when(event % 23 == 0, " ").when((event % 13 == 0) | (event % 3 == 0), as_json[0]).otherwise(as_json[1])
    return _events(spark, sf_dir).select(event, text.alias("value"))


def tank_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sensor(spark, sf_dir, {"tankId": _text("user_id"), "ts": _text("ms")}, "waterTankLevel")


def wind_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sensor(spark, sf_dir, {"geoZone": F.col("event_type")}, "windSpeed")


def _named(step: int) -> dict[str, Column]:
    return {"id": F.when(F.col("event_id") % step != 0, _text("user_id")), "ts": F.col("ms")}


def rpm_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sensor(spark, sf_dir, _named(19), "currentRpm")


def torque_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sensor(spark, sf_dir, _named(7), "currentTorque")


def well_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of which some carry the shared well name under a vendor's prefix."""
    event = F.col("event_id")
    name = F.when(event % 5 == 0, F.concat(F.lit("W"), "user_id")).when(event % 5 == 1, F.lit(""))
    record = F.struct(name.alias("tempus.nameWell"), _text("user_id").alias("nameWell"))
    return _events(spark, sf_dir).select(event, F.to_json(record).alias("value"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of four topic partitions, with offsets."""
    return _events(spark, sf_dir).select(
        F.col("event_type").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("props").alias("value"),
    )
