"""A log of numbered commits in a folder: the state of a table that several writers change.

Commit n is the file ``<n>.json``.  A commit is put where no file of its number is, or not at all,
so of two writers who both saw commit n - 1 one wins, and the other reads again and retries.
On HDFS and on local disks putting is atomic (a rename that never replaces, a hard link); a store
whose rename replaces silently needs one writer at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass
class CommitLog:
    spark: SparkSession
    path: str

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        return jvm, root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), root

    def latest(self) -> int:
        """The number of the newest commit; 0 where there is none."""
        _, fs, root = self._fs()
        if not fs.exists(root):
            return 0
        names = (st.getPath().getName() for st in fs.listStatus(root))
        return max((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), default=0)

    def read(self, number: int) -> str:
        jvm, fs, root = self._fs()
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(root, f"{number:020d}.json"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, number: int, text: str) -> bool:
        """Commit ``text`` as ``number``; False where another writer was first."""
        jvm, fs, root = self._fs()
        path = jvm.org.apache.hadoop.fs.Path
        fs.mkdirs(root)
        draft, place = path(root, f"_{uuid.uuid4().hex}"), path(root, f"{number:020d}.json")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        try:
            if fs.getScheme() == "file":
                files, at = jvm.java.nio.file.Files, jvm.java.io.File
                local = [at(p.toUri().getPath()).toPath() for p in (fs.makeQualified(place), fs.makeQualified(draft))]
                if files.exists(local[0], self.spark.sparkContext._gateway.new_array(jvm.java.nio.file.LinkOption, 0)):
                    return False
                try:
                    files.createLink(*local)
                    return True
                except Exception as e:
                    if "FileAlreadyExistsException" in str(e):
                        return False
                    raise
            return not fs.exists(place) and fs.rename(draft, place)
        finally:
            fs.delete(draft, False)
