"""Calls to a vision or OCR model, in partitions, with the client made where it is used."""

from __future__ import annotations

import base64
import os
import threading
import time
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from pathlib import Path
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..frames import map_frames
from ..functions import text as T


class OcrClient(Protocol):
    """Gets the message parts of one batch, gives the reply, input tokens and output tokens."""

    def invoke(self, parts: list[dict]) -> tuple[str, int, int]: ...


@dataclass(frozen=True)
class Options:
    max_image_size: tuple[int, int] = (2048, 2048)
    min_score: float = 0.5
    enable_dedup: bool = True
    dedup_scope: str = "corpus"
    prompt_path: str | None = None
    batch_size: int = 5
    filter_images: bool = True
    enable_ocr: bool = True
    max_retries: int = 2
    in_flight: int = 8  # calls that a task has open at once
    odd_shapes: bool = False  # drop odd shapes too
    rebatch: bool = False  # batches of what the filter leaves, not of all images
    mark_skipped: bool = False  # an image that is not sent leaves a message in its place

    def __post_init__(self):
        if not 1 <= self.batch_size <= 5:
            raise ValueError("batch_size must be 1 to 5")
        if self.dedup_scope not in ("corpus", "document"):
            raise ValueError("dedup_scope is corpus or document")


DEFAULT_PROMPT = "Read each image. Answer with the text of every image between <ID> and </ID>, where ID is the image's id."


def load_prompt(path: str | None) -> str:
    try:
        return Path(path).read_text(encoding="utf-8") if path else DEFAULT_PROMPT
    except OSError:
        return DEFAULT_PROMPT


def message(parts: list[dict]) -> list[dict]:
    """The parts as a chat model wants them: each with its own fields only, an image's data nested."""
    out = []
    for p in parts:
        if p["type"] == "text":
            out.append({"type": "text", "text": p["text"]})
        elif p["type"] == "image_url":
            out.append({"type": "image_url", "image_url": {"url": p["url"]}})
        else:
            out.append({"type": "image", "source": {"type": "base64", "media_type": p["media_type"], "data": p["data"]}})
    return out


def contents(parts: list[dict]) -> list[dict]:
    """The numbered form as a hosted SDK wants it: an entry for each image, its label and its bytes, and one for the prompt."""
    out, label = [], None
    for p in parts:
        if p["type"] == "text" and label is None and p["text"].startswith("Image "):
            label = p["text"]
        elif p["type"] == "text":
            out.append({"role": "user", "parts": [{"text": p["text"]}]})
        else:
            out.append({"role": "user", "parts": [{"text": label}, {"inline_data": {"mime_type": p["media_type"], "data": base64.b64decode(p["data"])}}]})
            label = None
    return out


def check_client(client) -> None:
    if not callable(getattr(client, "invoke", None)):
        raise TypeError("a client has a method invoke(parts)")


def guard(options: Options, make) -> None:
    """OCR needs to be enabled and to have a client."""
    if not options.enable_ocr or make is None:
        raise RuntimeError("OCR is disabled or has no client")


#: Failures of a call that another attempt may mend.
TRANSIENT = (ConnectionError, TimeoutError, OSError, RuntimeError)


def environment_client(kind: str = "google", model: str | None = None) -> Callable[[], OcrClient]:
    """A maker of a client for a hosted model; keys come from the environment, libraries only where it runs.

    Kinds: google and bedrock (chat models, url and source form), direct (the SDK, numbered form).
    """

    class Direct:
        def __init__(self):
            from google import genai

            self.client = genai.Client(api_key=os.environ["GOOGLE_API_KEY"])

        def invoke(self, parts):
            # Fixed values.
            config = {"temperature": 0.25, "top_p": 0.5, "response_mime_type": "text/plain", "thinking_config": {"thinking_budget": 0}, "seed": 42}
            reply = self.client.models.generate_content(model=model, contents=contents(parts), config=config)
            return reply.text, reply.usage_metadata.prompt_token_count, reply.usage_metadata.candidates_token_count

    if kind == "direct":
        return Direct

    class Chat:
        def __init__(self):
            if kind == "google":
                from langchain_google_genai import ChatGoogleGenerativeAI

                self.model = ChatGoogleGenerativeAI(model=model, temperature=0, max_retries=2, google_api_key=os.environ["GOOGLE_API_KEY"])
            elif kind == "bedrock":
                from langchain_aws import ChatBedrock

                self.model = ChatBedrock(model_id=model, model_kwargs={"temperature": 0})
            else:
                raise ValueError(f"no such client: {kind}")

        def invoke(self, parts):
            reply = self.model.invoke([{"role": "user", "content": message(parts)}])
            usage = getattr(reply, "usage_metadata", None) or {}
            return str(reply.content), usage.get("input_tokens", 0), usage.get("output_tokens", 0)

    return Chat


class LocalOcr:
    """A local engine as a client: ``read(data) -> [(bbox, (text, confidence)), ...]`` for one image."""

    def __init__(self, read: Callable[[str], list]):
        self.read = read

    def invoke(self, parts):
        out, current = [], None
        for p in parts:
            if p["type"] == "text" and (p["text"] or "").startswith("[ID: "):
                current = p["text"][5:].rstrip("\n").rstrip("]")
            elif p["type"] != "text":
                text = "\n".join(t for _, (t, _) in self.read(p["url"] or p["data"])).strip()
                out.append(f"<{current}>\n{text}\n</{current}>")
        return "\n".join(out), 0, 0


def attempt(client: OcrClient, parts: list[dict], max_retries: int, wait: float) -> tuple:
    """reply, error, elapsed_time, token_input, token_output of one batch; its failure is its own."""
    began, reply, error, usage = time.time(), None, None, (0, 0)
    for n in range(max_retries + 1):
        try:
            reply, *usage = client.invoke(parts)
            reply, error = str(reply), None
            break
        except Exception as e:  # reported in the batch's rows
            error = str(e) or type(e).__name__
            if not isinstance(e, TRANSIENT):
                break
            if n < max_retries:
                time.sleep(wait * 2**n)
    return reply, error, time.time() - began, *usage


def in_order(items: Iterator, work: Callable, in_flight: int) -> Iterator:
    """The results of ``work`` in the order of the items, up to ``in_flight`` of them at work at once; no more items are taken than that."""
    if in_flight == 1:
        yield from map(work, items)
        return
    with ThreadPoolExecutor(in_flight) as pool:
        waiting: deque = deque()
        try:
            for item in items:
                waiting.append(pool.submit(work, item))
                if len(waiting) >= in_flight:
                    yield waiting.popleft().result()
            while waiting:
                yield waiting.popleft().result()
        finally:  # a reader that stops early, or a failure: what has not begun does not begin
            for w in waiting:
                w.cancel()


def call(batches: DataFrame, make: Callable[[], OcrClient], max_retries: int = 2, wait: float = 1.0, in_flight: int = 1, shared: bool = True, record: Callable | None = None) -> DataFrame:
    """batches: doc_id, batch_no, ids, parts. Adds reply, error, elapsed_time, token_input, token_output.

    A task has up to ``in_flight`` calls open at once and gives their rows in the order of the batches. Its calls share one
    client, or with ``shared=False`` each thread makes its own. A failing batch fails alone. Transient failures are tried again after
    ``wait`` x 1, 2, 4, ... seconds, others reported at once. Write the result before using it twice: calls cost money.
    ``record`` (see ``ledger``) makes in each task a function that is given a row and the call, and may answer without it; rows then have a ``call_key``.
    """
    own = batches.select("doc_id", "batch_no", "ids", "parts", *["call_key"] * (record is not None))
    names = [f.name for f in own.schema.fields if f.name != "parts"]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, local, remember = None, threading.local(), record() if record else None

        def mine() -> OcrClient:
            if shared:
                return client
            if not hasattr(local, "client"):
                local.client = make()
                check_client(local.client)
            return local.client

        def one(row: dict) -> tuple:
            parts = [dict(p.asDict() if hasattr(p, "asDict") else p) for p in row["parts"]]
            ask = lambda: attempt(mine(), parts, max_retries, wait)
            return tuple(row[n] for n in names) + (remember(row["call_key"], ask) if remember else ask())

        if shared:
            client = make()
            check_client(client)
        sizes: deque[int] = deque()

        def rows() -> Iterator[dict]:
            for frame in frames:
                sizes.append(len(frame))
                yield from frame.to_dict("records")

        held, columns = [], [*names, "reply", "error", "elapsed_time", "token_input", "token_output"]
        for row in in_order(rows(), one, in_flight):
            held.append(row)
            if len(held) >= max(sizes[0], 1):
                sizes.popleft()
                yield pd.DataFrame(held, columns=columns)
                held = []

    added = StructType.fromDDL("reply string, error string, elapsed_time double, token_input long, token_output long")
    return map_frames(own, run, StructType([*[own.schema[n] for n in names], *added.fields]))


def usage(replies: DataFrame, key: str = "doc_id") -> DataFrame:
    """Calls, tokens and time of each key."""
    return replies.groupBy(key).agg(F.count("*").alias("calls"), F.sum("token_input").alias("token_input"), F.sum("token_output").alias("token_output"), F.sum("elapsed_time").alias("elapsed_time"))


def parse(replies: DataFrame) -> DataFrame:
    """image_id, content, status for every requested id: last segment wins, unknown ids go, the rest get a sentinel."""
    asked = replies.select("doc_id", "batch_no", "reply", "error", F.explode("ids").alias("image_id"))
    mine = lambda: F.filter(T.segments(F.coalesce("reply", F.lit(""))), lambda s: s["id"] == F.col("image_id"))
    content = F.try_element_at(mine(), F.lit(-1))["content"]
    failed = F.format_string(T.API_ERROR, F.col("error"))
    return asked.select("doc_id", "batch_no", "image_id", F.when(F.col("error").isNotNull(), failed).otherwise(F.coalesce(content, F.lit(T.NO_CONTENT))).alias("content"), F.when(F.col("error").isNotNull(), "api_error").when(content.isNull(), "no_content").otherwise("ok").alias("status"))
