"""Saving and loading fitted models, while others read them.

A model's folder holds ``versions`` and ``current``. A save writes a version
folder of its own and then renames one small file into ``current``, under a new
name that sorts last: the only step that readers can see. A reader takes the
last name there, so it gets the old model or the new one, never half of one.
"""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

#: Versions that stay, for readers that chose one before a newer was there.
KEPT_VERSIONS = 2


def model_path(root: str, name: str) -> str:
    return f"{root}/{name.replace(' ', '_').lower()}"


class _Folder:
    """The few file operations needed, on the file system that a path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        self.system = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts: str):
        return self.jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def names(self, folder: str) -> list[str]:
        if not self.system.exists(self._path(folder)):
            return []
        found = [s.getPath().getName() for s in self.system.listStatus(self._path(folder))]
        return sorted(n for n in found if not n.startswith((".", "_")))

    def publish(self, name: str) -> None:
        """Make an empty file under a hidden name, then rename it."""
        self.system.mkdirs(self._path("current"))
        hidden = self._path("current", f".{name}")
        self.system.create(hidden, False).close()
        if not self.system.rename(hidden, self._path("current", name)):
            raise OSError(f"{self.path}: {name} could not be published")

    def delete(self, *parts: str) -> None:
        self.system.delete(self._path(*parts), True)


def _version(pointer: str) -> str:
    """``number-version``: the number sorts, the version names the folder."""
    return pointer.split("-", 1)[1]


def save_model(model: PipelineModel, path: str, kept: int = KEPT_VERSIONS) -> str:
    """Write a new version and make it the current one; the version's path.

    Of saves at the same time the one published last is current, ties by
    version. Versions older than the ``kept`` latest are deleted, their
    pointers first; those of saves that are not published yet stay.
    """
    spark = SparkSession.active()
    folder, version = _Folder(spark, path), uuid.uuid4().hex
    target = f"{path}/versions/{version}"
    model.write().save(target)
    pointers = folder.names("current")
    number = int(pointers[-1].split("-")[0]) + 1 if pointers else 1
    folder.publish(f"{number:012d}-{version}")
    for old in folder.names("current")[: -max(kept, 1)]:
        folder.delete("current", old)
        folder.delete("versions", _version(old))
    return target


def current_version(path: str) -> str:
    """The path of the current version; raises where there is none."""
    pointers = _Folder(SparkSession.active(), path).names("current")
    if not pointers:
        raise FileNotFoundError(f"no model is saved at {path}")
    return f"{path}/versions/{_version(pointers[-1])}"


def save_models(models: dict[str, PipelineModel], root: str) -> dict[str, str]:
    """Every model at its own path below ``root``, as a new version."""
    paths = {name: model_path(root, name) for name in models}
    for name, model in models.items():
        save_model(model, paths[name])
    return paths


def load_model(root: str, name: str) -> PipelineModel:
    """The current version, whichever save is under way.

    Where saves followed each other so fast that the chosen version is gone
    before it has been read, the then current one is taken.
    """
    path = model_path(root, name)
    while True:
        version = current_version(path)
        try:
            return PipelineModel.load(version)
        except Exception:
            if current_version(path) == version:
                raise
