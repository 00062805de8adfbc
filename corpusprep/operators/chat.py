"""Chat rows with a JSON message list to export records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import iso_from_epoch

CHAT_JSON = "struct<messages: array<struct<role: string, content: string, modelName: string>>>"


def clean_messages(messages: Column) -> Column:
    """Role and content of every message; assistant messages also name their model."""

    def keep(message: Column) -> Column:
        model = F.when(message["role"] == "assistant", F.coalesce(message["modelName"], F.lit("assistant")))
        return F.struct(message["role"].alias("role"), message["content"].alias("content"), model.alias("model"))

    empty = F.array().cast("array<struct<role: string, content: string, model: string>>")
    return F.coalesce(F.transform(messages, keep), empty)


def export_chats(chats: DataFrame) -> DataFrame:
    """``id, title, chat, created_at, updated_at`` to one export record per chat, in message order."""
    parsed = chats.withColumn("_chat", F.from_json("chat", CHAT_JSON))
    return parsed.select(
        F.col("id").alias("chat_id"),
        "title",
        clean_messages(F.col("_chat.messages")).alias("messages"),
        iso_from_epoch(F.col("created_at")).alias("created_at"),
        iso_from_epoch(F.col("updated_at")).alias("updated_at"),
    )


def write_export(exported: DataFrame, folder: str, run_date: str) -> str:
    """JSON lines below a folder named by the run's date.

    Null fields are written; only ``model`` is left out where it does not apply.
    """

    def listed(message: Column) -> Column:
        both = [F.lit("role"), message["role"], F.lit("content"), message["content"]]
        with_model = F.create_map(*both, F.lit("model"), message["model"])
        return F.when(message["role"] == "assistant", with_model).otherwise(F.create_map(*both))

    path = f"{folder.rstrip('/')}/{run_date}"
    lines = exported.withColumn("messages", F.transform("messages", listed))
    lines.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path
