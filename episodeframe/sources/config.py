"""Mapping configuration.

A small driver-side config (YAML file or dict) names the topics feeding each
field, the cameras, and the state/action vector layouts.  It compiles to a
topic dimension DataFrame (bounded by the config's size, so broadcasting it
is safe) and to ``FieldSpec`` layouts used by the Column builders.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from episodeframe.functions.decoders import DECODER_SCHEMAS
from episodeframe.functions.vectors import Extractor, FieldSpec, validate_extractor

TOPIC_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType(), False),
    T.StructField("field", T.StringType(), False),
    T.StructField("decoder", T.StringType(), True),
    T.StructField("required", T.BooleanType(), False),
    T.StructField("priority", T.IntegerType(), False),
    T.StructField("kind", T.StringType(), False),
])

ACTION_MODES = ("next_state", "from_sources")


@dataclass
class MappingConfig:
    topics: list[tuple[str, str, str | None, bool, int, str]]
    state: list[FieldSpec]
    action: list[FieldSpec] = field(default_factory=list)
    action_mode: str = "next_state"
    fps: float = 30

    def topic_names(self) -> list[str]:
        return [t[0] for t in self.topics]

    def fields(self, kind: str = "observation") -> list[str]:
        seen = []
        for t in self.topics:
            if t[5] == kind and t[1] not in seen:
                seen.append(t[1])
        return seen

    def required_fields(self, kind: str = "observation") -> list[str]:
        return sorted({t[1] for t in self.topics if t[5] == kind and t[3]})


class ConfigError(ValueError):
    """All problems of a mapping config, one line each (``problems``)."""

    def __init__(self, problems: list[str]):
        super().__init__("; ".join(problems))
        self.problems = problems


#: Groups of topics: row kind by config key, and whether a field is required
#: and must name a decoder unless it says otherwise.
GROUPS = {"observations": ("observation", True, True), "cameras": ("camera", False, False)}


class _Reader:
    """Reads the plain data of a config; ``problems`` gathers what is wrong."""

    def __init__(self):
        self.problems: list[str] = []

    def say(self, where: str, what: str) -> None:
        self.problems.append(f"{where}: {what}")

    def entries(self, where: str, found) -> list[tuple[str, dict]]:
        """Enabled entries of a mapping or a list, each with its place."""
        if found is None:
            return []
        pairs = found.items() if isinstance(found, dict) else enumerate(found) if isinstance(found, list) else None
        if pairs is None:
            self.say(where, "expected a mapping or a list")
            return []
        out = []
        for name, entry in pairs:
            place = f"{where}.{name}"
            if not isinstance(entry, dict):
                self.say(place, "expected a mapping")
            elif entry.get("enabled", True):
                out.append((place, entry))
        return out

    def text(self, where: str, entry: dict, key: str, needed: bool = True) -> str | None:
        value = str(entry.get(key) or "").strip()
        if not value and needed:
            self.say(where, f"{key} is missing")
        return value or None

    def whole(self, where: str, entry: dict, key: str, default: int) -> int:
        try:
            return int(entry.get(key, default))
        except (TypeError, ValueError):
            self.say(where, f"{key} is not a whole number")
            return default

    def topics(self, section: dict) -> list[tuple[str, str, str | None, bool, int, str]]:
        rows = []
        for group, (kind, required, decoded) in GROUPS.items():
            for place, entry in self.entries(f"topics.{group}", section.get(group)):
                decoder = self.text(place, entry, "decoder", decoded)
                if decoder is not None and decoded and decoder not in DECODER_SCHEMAS:
                    self.say(place, f"unknown decoder {decoder!r}")
                candidates = self.entries(f"{place}.candidates", entry.get("candidates"))
                if not candidates:
                    self.say(place, "no enabled candidate topic")
                for spot, c in candidates:
                    topic = self.text(spot, c, "topic")
                    rows.append((topic, place.rsplit(".", 1)[-1], decoder, bool(entry.get("required", required)),
                                 self.whole(spot, c, "priority", int(spot.rsplit(".", 1)[-1])), kind))
        for topic, n in Counter(r[0] for r in rows if r[0]).items():
            if n > 1:
                self.say("topics", f"duplicate topic {topic!r}")
        return rows

    def layout(self, where: str, section: dict, sources: set[str]) -> list[FieldSpec]:
        out = []
        for place, entry in self.entries(f"{where}.fields", section.get("fields")):
            name = self.text(place, entry, "name")
            text = str(entry.get("extractor") or "").strip()
            source = self.text(place, entry, "source", needed=not text.startswith("constant:"))
            try:
                Extractor.parse(text)
            except ValueError as e:
                self.say(place, str(e))
            if source is not None and source not in sources:
                self.say(place, f"source {source!r} is not an observation")
            out.append(FieldSpec(name or "", source, text))
        for name, n in Counter(f.name for f in out if f.name).items():
            if n > 1:
                self.say(where, f"duplicate field {name!r}")
        return out


def parse_mapping_config(cfg: dict) -> MappingConfig:
    """Validate and compile a mapping config; ``ConfigError`` lists every problem.

    Disabled entries are dropped, a topic may feed only one field, priority
    defaults to the candidate's list position, observations are required and
    need a known decoder, cameras are optional unless stated, layout fields
    have distinct names and configured sources.  ``action.mode`` is
    ``next_state`` (no fields) or ``from_sources`` (as many fields as the
    state)."""
    read = _Reader()
    topics = read.topics(cfg.get("topics") or {})
    sources = {t[1] for t in topics if t[5] == "observation"}
    state = read.layout("state", cfg.get("state") or {}, sources)
    section = cfg.get("action") or {}
    mode = str(section.get("mode", ACTION_MODES[0]))
    action = read.layout("action", section, sources)
    if not state:
        read.say("state", "the vector is empty")
    if mode not in ACTION_MODES:
        read.say("action", f"unknown mode {mode!r}")
    elif mode == "next_state" and action:
        read.say("action", "next_state takes no fields")
    elif mode == "from_sources" and len(action) != len(state):
        read.say("action", f"width {len(action)} is not the state's width {len(state)}")
    try:
        fps = float(cfg.get("fps", 30))
        if not fps > 0:
            read.say("fps", "must be positive")
    except (TypeError, ValueError):
        read.say("fps", "is not a number")
    if read.problems:
        raise ConfigError(read.problems)
    return MappingConfig(topics, state, action, mode, int(fps) if fps == int(fps) else fps)


def load_yaml(path: str) -> dict:
    """Read a YAML config (PyYAML if installed; JSON is accepted too)."""
    text = open(path, encoding="utf-8").read()
    try:
        import yaml  # type: ignore
    except ImportError:
        import json
        return json.loads(text)
    return yaml.safe_load(text) or {}


def topic_dim(spark: SparkSession, config: MappingConfig) -> DataFrame:
    """The topic dimension ``(topic, field, decoder, required,
    priority, kind)``."""
    return spark.createDataFrame(config.topics, TOPIC_SCHEMA)


# ---------------------------------------------------------------- E2

_LAYOUTS: dict[str, list[FieldSpec]] = {}


def register_layout(name: str, layout: list[FieldSpec]) -> None:
    """A named per-model vector layout, meant to be edited by users."""
    for f in layout:
        validate_extractor(f.extractor, f"{name}.{f.name}")
    _LAYOUTS[name] = list(layout)


def layout(name: str) -> list[FieldSpec]:
    if name not in _LAYOUTS:
        raise KeyError(f"unknown vector layout {name!r}; known: {sorted(_LAYOUTS)}")
    return list(_LAYOUTS[name])


# ---------------------------------------------------------------- E3

# The collection switches and the data keys each one enables.
CAMERA_SWITCHES = ("head_rgb_stream", "head_depth_stream", "left_arm_rgb_stream", "right_arm_rgb_stream")
SENSOR_SWITCHES = (
    "left_arm_end_pose", "right_arm_end_pose", "wrench_ext_world", "wrench_ext_local",
    "waist_end_pose", "odometry", "pose", "chassis_imu", "depth_points", "head_depth_video",
    "laser_scan", "left_gripper_position", "right_gripper_position", "left_gripper_tactile",
    "right_gripper_tactile", "left_hand_tactile", "right_hand_tactile", "tof_sensors",
    "ultrasonic_sensors", "master_arm_data",
)


@dataclass
class CollectionSwitches:
    """Which streams a collection session records."""

    slave_joint_names: list[str] | None = None
    slave_action_names: list[str] | None = None
    enabled: set[str] = field(default_factory=set)

    def enabled_sensors(self) -> list[str]:
        return [s for s in CAMERA_SWITCHES + SENSOR_SWITCHES if s in self.enabled]

    def camera_names(self) -> list[str]:
        return [c for c in CAMERA_SWITCHES if c in self.enabled]

    def action_names(self) -> list[str]:
        if self.slave_action_names is not None:
            return list(self.slave_action_names)
        return [j.replace("_joint_states", "_actions") for j in (self.slave_joint_names or [])]

    def data_keys(self) -> list[str]:
        """Every data key the switches enable (joints, actions, sensors)."""
        return list(self.slave_joint_names or []) + self.action_names() + [
            s for s in SENSOR_SWITCHES if s in self.enabled]


def enabled_keys_dim(spark: SparkSession, switches: CollectionSwitches) -> DataFrame:
    """P2 as a dimension ``(data_key, severity)``: master-arm keys only warn."""
    rows = [(k, "warn" if k.startswith("master_arm") else "error") for k in switches.data_keys()]
    return spark.createDataFrame(rows, "data_key string, severity string")
