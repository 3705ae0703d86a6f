"""Record layouts. All numbers may arrive quoted, so records are decoded as text first."""

from __future__ import annotations

from dataclasses import dataclass

# field name -> Spark type, in wire order
TANK = {"tankId": "string", "ts": "bigint", "waterTankLevel": "double"}
WIND = {"geoZone": "string", "windSpeed": "double"}
RPM = {"id": "string", "ts": "string", "currentRpm": "double"}
TORQUE = {"id": "string", "ts": "string", "currentTorque": "double"}
BLOCK = {"id": "string", "ts": "bigint", "blockPosition": "double"}
RIG = {
    "id": "string",
    "ts": "bigint",
    "bitDepth": "double",
    "holeDepth": "double",
    "totalPumpOutput": "double",
    "rotaryRpm": "double",
    "inSlipStatus": "int",
    "standpipePressure": "double",
}

ENVELOPE_DDL = (
    "msgType string, deviceName string, deviceType string, "
    "cs map<string,string>, ss map<string,string>, "
    "tags array<struct<key:string,value:string,ts:bigint,ds:double>>"
)


@dataclass(frozen=True)
class LogKeys:
    """Names of the reserved keys of a well-log message.

    Some feeds put a vendor prefix before the depth/time, hint and shared
    well-name keys; give it as ``prefix``, with its dot.
    """

    prefix: str = ""

    @property
    def tsds(self) -> str:
        return self.prefix + "tsds"

    @property
    def hint(self) -> str:
        return self.prefix + "hint"

    @property
    def shared_well(self) -> str:
        return self.prefix + "nameWell"

    @property
    def reserved(self) -> tuple[str, ...]:
        return (self.tsds, self.hint, "nameWell", "nameWellbore", "LogName")


# Primary keys of the stored tables.
PRIMARY_KEYS = {
    "depth_log": ("namewell", "namewellbore", "namelog", "mnemonic", "depthstring"),
    "time_log": ("namewell", "namewellbore", "namelog", "mnemonic", "ts"),
    "trajectory": ("namewell", "namewellbore", "nametrajectory", "nametrajectorystn"),
    "well": ("namewell",),
    "wellbore": ("namewell", "namewellbore"),
    "rig": ("namewell", "namerig"),
    "offsetmgr": ("topic_name", "group_id", "partition"),
}

# Hash columns and bucket counts of the stored tables.
HASH_LAYOUT = {
    "depth_log": (("namewell",), 4),
    "time_log": (("namewell",), 4),
    "trajectory": (("namewell",), 2),
    "well": (("namewell",), 2),
    "wellbore": (("namewell",), 2),
    "rig": (("namewell", "namerig"), 2),
    "offsetmgr": (("topic_name",), 1),
}

# The columns of the offset ledger.
LEDGER = "topic_name string, group_id string, partition int, offsetid bigint"
