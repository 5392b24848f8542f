"""Small things done to a file store from the driver: markers, moves, deletions. Data never passes here."""

import uuid


def _at(spark, path):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark, path):
    store, where = _at(spark, path)
    return store.exists(where)


def delete(spark, path):
    """Remove a file or a folder with all it holds; nothing happens if there is none."""
    store, where = _at(spark, path)
    store.delete(where, True)


def delete_at_exit(spark, path):
    """Remove an existing folder when the driver's JVM ends in order."""
    store, where = _at(spark, path)
    store.deleteOnExit(where)


def children(spark, path, folders=None):
    """Names directly under a folder, sorted; only folders or only files if asked. A missing folder has none."""
    store, where = _at(spark, path)
    if not store.exists(where):
        return []
    found = store.listStatus(where)
    return sorted(s.getPath().getName() for s in found if folders is None or s.isDirectory() == folders)


def read_text(spark, path):
    """A small file as text, None if there is none."""
    store, where = _at(spark, path)
    if not store.exists(where):
        return None
    stream = store.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_text(spark, path, text):
    """Put a small file in place at once: a reader sees the old one or the new one, never a part."""
    store, where = _at(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(where.getParent(), f".{where.getName()}-{uuid.uuid4().hex}")
    stream = store.create(aside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
    option = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark._sc._gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    context.rename(store.makeQualified(aside), store.makeQualified(where), options)
