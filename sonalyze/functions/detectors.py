"""Speech detectors: a black box from audio paths to tagged text, loaded once in each Python worker."""

from __future__ import annotations

import hashlib
import importlib.metadata
import sys
import types
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sonalyze.operators.review import FAILED
from sonalyze.shared import ship

#: From a path to a list of results with text; where the detector takes batches, from paths to a list for each.
Generate = Callable[[str], list[dict]] | Callable[[list[str]], list[list[dict]]]
#: The models of a worker, by loader, model and device, are held in a module of this name.
HELD = "_speech_models"
#: A device that each task takes from the resources that Spark gave it.
OF_TASK = "task"


def library_version(library: str = "funasr") -> str:
    """The installed version, as the raw records name it."""
    try:
        return importlib.metadata.version(library)
    except importlib.metadata.PackageNotFoundError:
        return "unknown"


@dataclass(frozen=True)
class Detector:
    """load(model, device) gives a function from a path to a list of results with text. provenance goes into
    the raw records.

    batch: how many paths a call takes; above 1 the function is from a list of paths to a list of results for each. device:
    "task" is the one that Spark gave the task, where each needs `gpus` of them, and else the CPU. seconds: a call that takes
    longer is a failure of its lines.
    """

    load: Callable[[str, str], Generate]
    model: str = "iic/SenseVoiceSmall"
    device: str = "cpu"
    name: str = "SenseVoiceSmall"
    version: str = field(default_factory=library_version)
    output_type: str = "asr_ser_aed"
    options: dict = field(default_factory=dict, compare=False)
    batch: int = 1
    gpus: float = 0
    seconds: float | None = None

    @property
    def provenance(self) -> dict[str, str]:
        return {"name": self.name, "funasr_version": self.version, "model": self.model, "device": self.device, "output_type": self.output_type}


def default_device() -> str:
    """cuda:0 where torch finds it."""
    try:
        import torch
    except ImportError:
        return "cpu"
    return "cuda:0" if torch.cuda.is_available() else "cpu"


def task_device(resources: dict) -> str:
    """The device of a task with these resources."""
    gpu = resources.get("gpu")
    return f"cuda:{gpu.addresses[0]}" if gpu is not None and gpu.addresses else "cpu"


def funasr_model(model: str, device: str) -> Generate:
    """The production model; its library is optional."""
    try:
        from funasr import AutoModel
    except ImportError as e:
        raise RuntimeError("funasr is not installed; audio can't be recognized without it") from e
    loaded = AutoModel(model=model, device=device, disable_update=True)
    return lambda path: loaded.generate(input=path, language="auto", use_itn=True)


def bounded(call: Callable, seconds: float | None) -> Callable:
    """call, which fails after so many seconds; what it goes on with then is no one's."""
    if seconds is None:
        return call

    def run(x):
        pool = ThreadPoolExecutor(1)
        try:
            return pool.submit(call, x).result(seconds)
        except TimeoutError:
            raise TimeoutError(f"no result within {seconds:g} s") from None
        finally:
            pool.shutdown(wait=False)

    return run


def answers(generate: Generate, paths: list[str], detector: Detector) -> list[tuple[str | None, str | None]]:
    """Text or error of each path. A batch that fails is asked again line by line, so that one line's fault is its own."""
    call = bounded(generate, detector.seconds)
    text = lambda found: str(found[0].get("text", "")) if found else ""
    if detector.batch > 1 and len(paths) > 1:
        try:
            found = call(paths)
            if len(found) != len(paths):
                raise ValueError(f"{len(found)} results for {len(paths)} lines")
            return [(text(f), None) for f in found]
        except Exception:
            return [a for p in paths for a in answers(generate, [p], detector)]
    out: list[tuple[str | None, str | None]] = []
    for path in paths:
        try:
            out.append((text(call([path])[0] if detector.batch > 1 else call(path)), None))
        except Exception as e:  # one line's fault is that line's record
            out.append((None, str(e)))
    return out


def detect(lines: DataFrame, detector: Detector, path: str = "audio_path") -> DataFrame:
    """lines with raw_output and error, and unavailable set where the model failed on a line. Lines that are
    unavailable already are passed on; a failure on one line leaves the others as they are. The model is loaded
    before a worker's first line, and a model that can't be loaded ends the job."""
    ship(lines.sparkSession)
    schema = T.StructType([*(f for f in lines.schema.fields if f.name not in ("raw_output", "error")), T.StructField("raw_output", T.StringType()), T.StructField("error", T.StringType())])
    loader = hashlib.sha256(cloudpickle.dumps(detector.load)).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        held = sys.modules.setdefault(HELD, types.ModuleType(HELD)).__dict__
        device = task_device(TaskContext.get().resources()) if detector.device == OF_TASK else detector.device
        key = (loader, detector.model, device)
        for batch in batches:
            if len(batch) and key not in held:
                held[key] = detector.load(detector.model, device)
            reasons = [None if r is None or r != r else r for r in batch["unavailable"]]
            out: list[str | None] = [None] * len(batch)
            errors = list(out)
            there = [i for i, r in enumerate(reasons) if r is None]
            paths = list(batch[path])
            for at in range(0, len(there), detector.batch):
                some = there[at : at + detector.batch]
                for i, (text, error) in zip(some, answers(held[key], [paths[i] for i in some], detector)):
                    out[i], errors[i] = text, error
                    reasons[i] = None if error is None else FAILED
            yield batch.drop(columns=["raw_output", "error"], errors="ignore").assign(unavailable=reasons, raw_output=out, error=errors)[[f.name for f in schema.fields]]

    return lines.mapInPandas(run, schema, profile=_profile(detector))


def _profile(detector: Detector):
    """Tasks that each have the detector's devices."""
    if not detector.gpus:
        return None
    from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests

    return ResourceProfileBuilder().require(TaskResourceRequests().resource("gpu", detector.gpus)).build
