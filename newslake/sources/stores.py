"""Files of a store as tasks read and write them, through Arrow."""

from pyarrow import fs as arrow_fs


def open_store(uri: str):
    """The file system of a URI and the path in it; the schemes that Spark and Arrow name differently are translated."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return arrow_fs.LocalFileSystem(), uri
    if scheme in ("s3a", "s3n"):
        uri = f"s3:{rest}"
    if scheme == "file":
        return arrow_fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return arrow_fs.FileSystem.from_uri(uri)
