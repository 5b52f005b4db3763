"""Detected objects: cleaning, categories and object-based clip bonuses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Object classes per category.
FOOD_AND_DRINK = (
    "bowl", "banana", "apple", "sandwich", "orange", "carrot", "hot dog", "pizza", "donut", "cake", "cup", "bottle",
)
PEOPLE = ("person",)
SCREENS = ("cell phone", "laptop", "tv/monitor", "book", "mouse", "remote")
DEVICES = ("cell phone", "laptop", "tv", "mouse", "remote", "keyboard", "book")
PETS = ("cat", "dog", "bird", "teddy bear")
PROPS = ("vase", "clock", "scissors", "hair drier", "toothbrush")

# Per vocabulary: category name -> classes.
VOCABULARIES: dict[str, dict[str, tuple[str, ...]]] = {
    "topic": {
        "food": FOOD_AND_DRINK,
        "person": PEOPLE,
        "device/screen": SCREENS,
        "animal": (*PETS, "horse"),
    },
    "scene": {
        "food/drink": (*FOOD_AND_DRINK, "dining table"),
        "person": PEOPLE,
        "device": DEVICES,
        "pet": PETS,
        "object": PROPS,
    },
    "scene_wide": {
        "food/drink": (*FOOD_AND_DRINK, "dining table"),
        "person": PEOPLE,
        "device": (*DEVICES, "tv/monitor"),
        "pet": PETS,
        "object": PROPS,
    },
}

# Weight in tenths of a label that contains the word.
USEFUL_WORD_TENTHS = {
    "face": 10, "person": 8, "monitor": 9, "screen": 9, "tv": 8, "laptop": 8, "phone": 8, "cell phone": 8,
    "keyboard": 7, "mouse": 6, "controller": 8, "remote": 5, "bottle": 5, "cup": 5, "drink": 6, "food": 6,
    "pizza": 6, "sandwich": 6, "cake": 5, "bowl": 4,
}


def category(class_name: Column, vocabulary: str = "scene_wide") -> Column:
    """Category of an object class, NULL when the vocabulary does not know it."""
    name = F.lower(class_name)
    branches = [F.when(name.isin(*classes), label) for label, classes in VOCABULARIES[vocabulary].items()]
    return F.coalesce(*branches)


def label_tenths(label: Column) -> Column:
    """Largest weight (in tenths) of the useful words inside a label; 0 if none."""
    hits = [F.when(label.contains(word), F.lit(w)).otherwise(F.lit(0)) for word, w in USEFUL_WORD_TENTHS.items()]
    return F.greatest(*hits)


def compact_detections(detections: DataFrame) -> DataFrame:
    """Distinct lower-case labels per second of a video."""
    return (
        detections.select("vod_id", "second_s", F.lower(F.trim("class_name")).alias("label"))
        .where(F.col("label") != "")
        .distinct()
    )


def seconds_with_labels(detections: DataFrame) -> DataFrame:
    """One row per second with its sorted labels (a set of class names, so small)."""
    return compact_detections(detections).groupBy("vod_id", "second_s").agg(
        F.array_sort(F.collect_set("label")).alias("labels")
    )


def confident_detections(
    detections: DataFrame, min_confidence: float = 0.35, seconds_per_frame: int = 5, frame_shift: int = 0
) -> DataFrame:
    """Detections at or above ``min_confidence``; the time comes from the number in
    the frame name (``frame_000012.jpg``), ``seconds_per_frame`` apart."""
    number = F.regexp_extract("frame_name", r"(\d+)", 1).try_cast("bigint")
    return (
        detections.where(F.col("confidence") >= min_confidence)
        .withColumn("second_s", (number - frame_shift) * seconds_per_frame)
        .where(F.col("second_s").isNotNull())
    )
