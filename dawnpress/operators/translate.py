"""Translation of displayed titles: cache first, then a chain of providers."""

from __future__ import annotations

import html
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (name, text -> text). OSError retires a provider for the batch; ValueError skips one text.
Provider = tuple[str, Callable[[str], str]]


def _some(text: str) -> str:
    if not text.strip():
        raise ValueError("empty translation")
    return text


def parse_chunks(reply: bytes) -> str:
    """Nested arrays, a chunk per sentence."""
    try:
        return _some("".join(c[0] for c in json.loads(reply)[0] if c and c[0]))
    except (TypeError, IndexError, KeyError, AttributeError, json.JSONDecodeError) as e:
        raise ValueError("unknown reply") from e


def parse_flat(reply: bytes) -> str:
    """``["text"]`` or ``[["text", "en"]]``."""
    try:
        first = json.loads(reply)[0]
        return _some(first if isinstance(first, str) else first[0])
    except (TypeError, IndexError, KeyError, AttributeError, json.JSONDecodeError) as e:
        raise ValueError("unknown reply") from e


def parse_status(reply: bytes) -> str:
    """An object with the text and a status; a used-up quota answers with a warning instead of a text."""
    try:
        data = json.loads(reply)
        text = html.unescape(data["responseData"]["translatedText"])
        if int(data.get("responseStatus", 200)) != 200 or "MYMEMORY WARNING" in text.upper():
            raise OSError("quota")
        return _some(text)
    except (TypeError, IndexError, KeyError, AttributeError, json.JSONDecodeError) as e:
        raise ValueError("unknown reply") from e


def run_chain(texts: list[str], providers: list[Provider]) -> list[tuple[str, str, str]]:
    """(source, result, provider) for the texts that some provider translated."""
    alive, out = list(providers), []
    for t in texts:
        for p in list(alive):
            try:
                out.append((t, _some(p[1](t)), p[0]))
                break
            except OSError:
                alive.remove(p)
            except ValueError:
                break
        if not alive:
            break
    return out


def translate_missing(texts: DataFrame, cache: DataFrame, providers: list[Provider]) -> DataFrame:
    """``source, result, provider`` for distinct ``texts(source)`` that the cache lacks. The chain keeps its
    state over all texts, so they go through one partition: they are the displayed ones, a few per edition."""
    missing = texts.where("source is not null").distinct().join(cache.select("source"), "source", "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        todo = [t for f in frames for t in f["source"]]
        yield pd.DataFrame(run_chain(todo, providers), columns=["source", "result", "provider"])

    return missing.coalesce(1).mapInPandas(run, "source string, result string, provider string")


def provider_usage(results: DataFrame) -> DataFrame:
    return results.groupBy("provider").agg(F.count(F.lit(1)).alias("n"))


def apply_translations(shown: DataFrame, cache: DataFrame) -> DataFrame:
    """Displayed foreign events with translated title and summary; the original title is carried along."""
    c = lambda k: cache.select(F.col("source").alias(f"__{k}"), F.col("result").alias(f"__{k}_to"))
    foreign = F.col("lang") == "en"
    j = shown.join(c("t"), foreign & (F.col("title") == F.col("__t")), "left").join(c("s"), foreign & (F.col("summary") == F.col("__s")), "left")
    keep = [x for x in shown.columns if x not in ("title", "summary")]
    return j.select(*keep, F.coalesce("__t_to", "title").alias("title"), F.coalesce("__s_to", "summary").alias("summary"), F.when(F.col("__t_to").isNotNull(), F.col("title")).alias("title_original"))
