"""Content for image blocks from a vision-language model."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.request
from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.fixed import IMAGE_LABELS, MISSING_IMAGE

PAGE = ["doc_id", "page_index"]

#: What is asked for where no prompt is given.
PROMPTS = {
    "table": "Write this table as HTML. Keep all cells and their text.",
    "chart": "Describe this chart: its axes, series and what it shows.",
    "figure": "Describe this figure and all text in it.",
    "image": "Describe this image and all text in it.",
    "formula": "Write this formula as LaTeX.",
}

Backend = Callable[[bytes, str, str], str]


def prompt_of(label: Column, prompts: dict[str, str] | None = None) -> Column:
    """Prompt of a label; given ones win over the defaults."""
    table = PROMPTS | (prompts or {})
    out = F.lit(None).cast("string")
    for name in sorted(table, reverse=True):
        out = F.when(label == name, table[name]).otherwise(out)
    return out


def join_images(blocks: DataFrame, images: DataFrame, how: str = "inner") -> DataFrame:
    """Image blocks with their image, by page file stem, block and label.

    ``blocks`` has ``file_stem``, the page file's name without ending.  An image
    names that stem as it is, or less its ``_0_res`` or ``..._res`` ending; of
    several page files that fit, the nearest rule and then the smallest name
    count.  Where images have a ``doc_id``, they are only looked for in blocks
    of that document.
    """
    own = ["doc_id"] if "doc_id" in images.columns else []
    few = blocks.where(F.col("block_label").isin(IMAGE_LABELS))
    stem = F.col("file_stem")
    names = F.array_distinct(F.array(stem, F.regexp_replace(stem, "_0_res$", ""), F.regexp_replace(stem, "_res$", "")))
    keyed = few.select("*", F.posexplode(names).alias("rule", "json_stem"))
    png = images.select(*own, "json_stem", "block_idx", "block_label", "block_id", "png")
    hit = keyed.join(png.withColumnRenamed("block_id", "image_id"), [*own, "json_stem", "block_idx", "block_label"])
    best = hit.groupBy(*own, "image_id").agg(F.min(F.struct("rule", "file_stem")).alias("best"))
    hit = hit.join(best, [*own, "image_id"]).where((F.col("rule") == F.col("best.rule")) & (F.col("file_stem") == F.col("best.file_stem"))).drop("best", "rule", "json_stem")
    if how == "inner":
        return hit
    return few.join(hit.select(*PAGE, "block_idx", "image_id", "png"), [*PAGE, "block_idx"], "left")


def in_flight(call: Callable, rows: Iterable[tuple], workers: int) -> Iterator:
    """``call(*row)`` of each row, in order, with ``workers`` calls at a time and as many more waiting.

    Rows are taken as calls end, so no more of them are held than these.
    """
    with ThreadPoolExecutor(workers) as pool:
        held: deque[Future] = deque()
        for row in rows:
            held.append(pool.submit(call, *row))
            if len(held) >= 2 * workers:
                yield held.popleft().result()
        while held:
            yield held.popleft().result()


def describe(images: DataFrame, backend: Backend, prompts: dict[str, str] | None = None, workers: int = 1) -> DataFrame:
    """``images`` with ``answer`` and ``failed``: what the model says of each, or the error's text.

    A task has ``workers`` calls in flight; answers stay with their images.
    """
    asked = images.withColumn("prompt", prompt_of(F.col("block_label"), prompts))

    def one(p: bytes, kind: str, q: str) -> tuple[str, bool]:
        try:
            return backend(bytes(p), kind, q), False
        except Exception as e:  # a call that fails leaves its text, and the others go on
            return str(e), True

    @F.pandas_udf("struct<answer:string,failed:boolean>")
    def ask(png: pd.Series, label: pd.Series, prompt: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(list(in_flight(one, zip(png, label, prompt, strict=True), workers)), columns=["answer", "failed"])

    return asked.withColumn("__a", ask("png", "block_label", "prompt")).withColumns({"answer": F.col("__a.answer"), "failed": F.col("__a.failed")}).drop("__a", "prompt")


def fill_images(blocks: DataFrame, images: DataFrame, backend: Backend, prompts: dict[str, str] | None = None, batch: bool = True, workers: int = 1) -> DataFrame:
    """Blocks with the model's content; see :func:`with_answers`."""
    return with_answers(blocks, describe(join_images(blocks, images), backend, prompts, workers), batch)


def with_answers(blocks: DataFrame, answers: DataFrame, batch: bool = True) -> DataFrame:
    """Blocks with the answers of :func:`describe`.

    In batches, blocks without an image stay as they are; one by one, they say
    which file is missing.
    """
    answers = answers.select(*PAGE, "block_idx", "answer")
    met = blocks.join(answers, [*PAGE, "block_idx"], "left")
    missing = F.format_string(MISSING_IMAGE.replace("{}", "%s_block_%d.png"), F.col("file_stem"), F.col("block_idx"))
    is_image = F.col("block_label").isin(IMAGE_LABELS) & (F.size("pdf_bbox") == 4)
    otherwise = F.col("block_content") if batch else F.when(is_image, missing).otherwise(F.col("block_content"))
    return met.withColumn("block_content", F.coalesce("answer", otherwise)).drop("answer")


def request_body(png: Column, prompt: Column, model: str = "vlm", max_tokens: int = 2048, temperature: float = 0.1) -> Column:
    """JSON of a chat request with the image as a data URL."""
    url = F.concat(F.lit("data:image/png;base64,"), F.base64(png))
    image = F.to_json(F.struct(F.lit("image_url").alias("type"), F.struct(url.alias("url")).alias("image_url")))
    text = F.to_json(F.struct(F.lit("text").alias("type"), prompt.alias("text")))
    head = f'{{"model":{json.dumps(model)},"max_tokens":{max_tokens},"temperature":{temperature},"messages":[{{"role":"user","content":['
    return F.concat(F.lit(head), image, F.lit(","), text, F.lit("]}]}"))


def answer_of(response: Column) -> Column:
    """Stripped content of the first choice of a response; null if there is none."""
    return F.trim(F.get_json_object(response, "$.choices[0].message.content"))


class ChatBackend:
    """Calls an OpenAI-compatible server.

    A call that the server can't take now (no connection, 429 or an error of
    its own) is made again after ``wait`` seconds, then twice that and so on,
    up to ``tries`` calls; other refusals are errors at once.
    """

    def __init__(self, api_base: str, api_key: str = "", model: str = "vlm", timeout: float = 120, tries: int = 2, wait: float = 0.5, most_wait: float = 30.0):
        self.url = api_base.rstrip("/") + "/chat/completions"
        self.key, self.model, self.timeout, self.tries, self.wait, self.most_wait = api_key, model, timeout, tries, wait, most_wait

    def __call__(self, png: bytes, label: str, prompt: str) -> str:
        import base64

        parts = [{"type": "image_url", "image_url": {"url": "data:image/png;base64," + base64.b64encode(png).decode()}}, {"type": "text", "text": prompt}]
        body = json.dumps({"model": self.model, "max_tokens": 2048, "temperature": 0.1, "messages": [{"role": "user", "content": parts}]}).encode()
        request = urllib.request.Request(self.url, body, {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"})
        for k in range(self.tries):
            try:
                with urllib.request.urlopen(request, timeout=self.timeout) as r:
                    choices = json.load(r).get("choices") or []
                break
            except OSError as e:
                refused = isinstance(e, urllib.error.HTTPError) and e.code != 429 and e.code < 500
                if refused or k + 1 == self.tries:
                    raise
                time.sleep(min(self.most_wait, self.wait * 2**k))
        if not choices:
            raise ValueError("the response has no choices")
        return choices[0]["message"]["content"].strip()


def stub_backend(png: bytes, label: str, prompt: str) -> str:
    """For tests: says what it was given."""
    return f"{label}:{len(png)}"


def by_label(functions: dict[str, Callable[[bytes], str]]) -> Backend:
    """A backend of one function a label, for users' own functions."""

    def call(png: bytes, label: str, prompt: str) -> str:
        return functions[label](png)

    return call


def label_functions(backend: Backend | None, prompts: dict[str, str] | None = None) -> dict[str, Callable[[bytes], str]]:
    """A function of an image for each label; without a backend each says only what it was asked for."""
    asked = PROMPTS | (prompts or {})

    def made(label: str) -> Callable[[bytes], str]:
        return lambda png: backend(png, label, asked[label]) if backend else f"[{label}]"

    return {label: made(label) for label in IMAGE_LABELS}
