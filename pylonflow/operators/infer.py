"""Model inference over a column of prompts (the lateral model-call operator).

``predict`` appends one model response per input row. The call is a
user-supplied Python callable ``(system_prompt, prompt, params) -> str``;
a network client is the user's business, the engine owns concurrency,
pacing, retries and timeouts: a call that does not return within
``client_timeout`` counts as failed and is retried, whatever the client does.

Physical shape: ``filter(prompt IS NOT NULL)`` -> optional
``repartition(n_callers)`` -> ``mapInPandas``. Each Python task is one
serial caller, so ``n_callers`` is the number of calls in flight; without it
every partition is a caller, as many as tasks run at once. Set it whenever
the model has a quota. Rows reach
Python as Arrow batches; only the columns of the frame passed in travel, so
project before calling.
"""

from __future__ import annotations

import queue
import re
import threading
import time
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pylonflow.session import ship_package

# The instruction given with every prompt. Only the labels are fixed (the parser reads them); the wording is a default.
SYSTEM_PROMPT = (
    "Write a runbook for the network alert that follows. Put each item on a line of its own behind its label, "
    "in this order, and write nothing else.\n"
    "SEVERITY: one word, CRITICAL, HIGH, MEDIUM or LOW\n"
    "DIAGNOSIS: the likely cause, briefly\n"
    "ACTION1: the first step\n"
    "ACTION2: the next step\n"
    "ACTION3: the step after that\n"
    "ESCALATION: whom to call, and by when\n"
    "TICKET: priority P1, P2, P3 or P4"
)

ModelCall = Callable[[str, str, dict], str]


@dataclass(frozen=True)
class ModelSpec:
    """Model configuration (what a MODEL catalog object would hold)."""

    name: str = "runbook_model"
    task: str = "text_generation"
    system_prompt: str = SYSTEM_PROMPT
    temperature: float = 0.1
    max_tokens: int = 1024
    input_col: str = "prompt"
    output_col: str = "response"
    extra: dict = field(default_factory=dict)

    def params(self) -> dict:
        return {"task": self.task, "temperature": self.temperature, "max_tokens": self.max_tokens, **self.extra}


@dataclass(frozen=True, kw_only=True)
class CallOptions:
    """Per-call options (the options map of the model call).

    ``async_enabled=False`` means one call in flight per caller (``True``:
    up to ``max_in_flight`` concurrent calls per caller, results kept in row
    order); the number of callers is ``predict(n_callers=...)``.
    ``calls_per_minute`` paces each caller (call starts at least 60/rate s
    apart, remembered per Python worker across tasks and micro-batches; a
    worker that does not know when its caller last called waits a whole gap
    first, so that new workers cannot exceed it). ``total_calls_per_minute``
    is a budget for all callers together (a provider quota), split evenly
    over ``n_callers``: however many workers come and go, at most
    ``n_callers`` tasks call, each at its share. ``retry_count`` extra
    attempts follow a failure with exponential back-off starting at
    ``backoff_s``. ``client_timeout`` (seconds) is enforced on every attempt
    and also handed to the callable in ``params``.
    Keyword-only, so adding an option never shifts the meaning of others.
    """

    async_enabled: bool = False
    retry_count: int = 3
    client_timeout: float = 30.0
    backoff_s: float = 1.0
    calls_per_minute: float | None = None
    total_calls_per_minute: float | None = None
    max_in_flight: int = 4


class ModelCallError(RuntimeError):
    pass


# Per Python worker process: start time of the last call, per pacing key. Python
# workers are reused across tasks, so pacing carries over from one task or
# micro-batch to the next on the same worker.
_LAST_CALL: dict[str, float] = {}


def pacing_key(model: ModelSpec, call: ModelCall, min_gap: float) -> str:
    return f"{model.name}|{getattr(call, '__module__', '')}.{getattr(call, '__qualname__', 'call')}|{min_gap}"


class _Pacer:
    def __init__(self, key: str, min_gap: float):
        self.key, self.min_gap = key, min_gap
        self._lock = threading.Lock()

    def wait(self) -> None:
        if not self.min_gap:
            return
        with self._lock:
            last = _LAST_CALL.setdefault(self.key, time.monotonic())   # a new worker: as if it had just called
            wait = last + self.min_gap - time.monotonic()
            if wait > 0:
                time.sleep(wait)
            _LAST_CALL[self.key] = time.monotonic()


def call_within(call: ModelCall, system_prompt: str, prompt: str, params: dict, timeout: float | None) -> str:
    """Run the call in a thread of its own; a ``TimeoutError`` after ``timeout`` seconds leaves it behind."""
    if not timeout:
        return call(system_prompt, prompt, params)
    done: queue.SimpleQueue = queue.SimpleQueue()

    def run() -> None:
        try:
            done.put((True, call(system_prompt, prompt, params)))
        except BaseException as exc:  # noqa: BLE001 - handed to the caller
            done.put((False, exc))

    threading.Thread(target=run, daemon=True).start()   # a daemon: a hung call does not keep the worker alive
    try:
        ok, value = done.get(timeout=timeout)
    except queue.Empty:
        raise TimeoutError(f"no answer within {timeout:g} s") from None
    if not ok:
        raise value
    return value


def _call_with_retry(call: ModelCall, system_prompt: str, prompt: str, params: dict, opts: CallOptions,
                     sleep=time.sleep, before_attempt=None) -> str:
    attempt = 0
    while True:
        try:
            if before_attempt is not None:
                before_attempt()  # pacing applies to every attempt, retries included
            return call_within(call, system_prompt, prompt, params, opts.client_timeout)
        except Exception as exc:  # noqa: BLE001 - any provider failure is retried
            if attempt >= opts.retry_count:
                raise ModelCallError(f"model call failed after {attempt + 1} attempts: {exc}") from exc
            sleep(opts.backoff_s * (2 ** attempt))
            attempt += 1


def predict(
    df: DataFrame,
    call: ModelCall,
    model: ModelSpec = ModelSpec(),
    prompt_col: str | None = None,
    output_col: str | None = None,
    options: CallOptions = CallOptions(),
    n_callers: int | None = None,
    on_error: str = "raise",
) -> DataFrame:
    """Append ``output_col`` (string) with the model's answer to each prompt.

    Inner semantics: a row whose prompt is NULL produces no output row. With
    ``on_error="raise"`` (default) a call that fails after all retries fails
    the task (Spark retries the task); ``on_error="column"`` instead records
    the message in ``<output_col>_error`` and leaves the response NULL.
    """
    prompt_col = prompt_col or model.input_col
    output_col = output_col or model.output_col
    if on_error not in ("raise", "column"):
        raise ValueError("on_error must be 'raise' or 'column'")
    ship_package(df.sparkSession)
    src = df.filter(F.col(prompt_col).isNotNull())
    if n_callers:
        src = src.repartition(int(n_callers))
    fields = list(src.schema.fields) + [T.StructField(output_col, T.StringType(), True)]
    if on_error == "column":
        fields.append(T.StructField(output_col + "_error", T.StringType(), True))
    out_schema = T.StructType(fields)
    system_prompt, params = model.system_prompt, {**model.params(), "client_timeout": options.client_timeout}
    per_caller = options.calls_per_minute
    if options.total_calls_per_minute:
        if not n_callers:
            raise ValueError("total_calls_per_minute needs n_callers (the budget is split over the callers)")
        share = options.total_calls_per_minute / int(n_callers)
        per_caller = min(per_caller, share) if per_caller else share
    min_gap = 60.0 / per_caller if per_caller else 0.0
    pace_key = pacing_key(model, call, min_gap)

    def one(prompt, pacer):
        try:
            return _call_with_retry(call, system_prompt, prompt, params, options, before_attempt=pacer.wait), None
        except ModelCallError as exc:
            if on_error == "raise":
                raise
            return None, str(exc)

    def run(batches):
        pacer = _Pacer(pace_key, min_gap)
        pool = None
        if options.async_enabled and options.max_in_flight > 1:
            from concurrent.futures import ThreadPoolExecutor
            pool = ThreadPoolExecutor(max_workers=options.max_in_flight)
        try:
            for pdf in batches:
                prompts = pdf[prompt_col].tolist()
                results = (list(pool.map(lambda p: one(p, pacer), prompts)) if pool
                           else [one(p, pacer) for p in prompts])
                answers = [r[0] for r in results]
                errors = [r[1] for r in results]
                pdf = pdf.assign(**{output_col: pd.Series(answers, index=pdf.index, dtype=object)})
                if on_error == "column":
                    pdf[output_col + "_error"] = pd.Series(errors, index=pdf.index, dtype=object)
                yield pdf
        finally:
            if pool:
                pool.shutdown(wait=True)

    return src.mapInPandas(run, out_schema)


# --- deterministic local model for tests and benchmarks ---------------------

_AVG_T = re.compile(r"AvgTemp:(\S+?)C")
_TOWER = re.compile(r"^Tower:(\S+)")
# Stub model grading (lower bound of AvgTemp, severity, ticket).
STUB_GRADES = ((91.5, "CRITICAL", "P1"), (90.0, "HIGH", "P2"), (88.0, "MEDIUM", "P3"))


def rule_model(system_prompt: str, prompt: str, params: dict) -> str:
    """Stub model: grades the prompt's AvgTemp and returns a seven-line runbook.

    Its text is a formula of the alert columns, so SQL can rebuild it.
    """
    t_txt = _AVG_T.search(prompt).group(1)
    tower = _TOWER.match(prompt).group(1)
    t = float(t_txt)
    sev, ticket = next(((s, p) for lo, s, p in STUB_GRADES if t >= lo), ("LOW", "P4"))
    return (f"SEVERITY: {sev}\nDIAGNOSIS: average {t_txt}C over limit\nACTION1: check {tower}\n"
            f"ACTION2: reduce power\nACTION3: dispatch engineer\nESCALATION: shift lead\nTICKET: {ticket}")
