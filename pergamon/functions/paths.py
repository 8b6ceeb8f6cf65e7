"""Path and name columns."""

from pyspark.sql import functions as F

from pergamon import fixed_values as V


def _col(column):
    return F.col(column) if isinstance(column, str) else column


def base_name(path):
    return F.substring_index(_col(path), "/", -1)


def dir_name(path):
    path = _col(path)
    return F.when(F.instr(path, "/") == 0, F.lit("")).otherwise(
        F.regexp_replace(path, "/[^/]*$", "")
    )


def join_path(folder="folder_name", name="file_name"):
    """NULL if either part is NULL."""
    return F.concat(_col(folder), F.lit("/"), _col(name))


def add_scheme(path):
    return F.concat(F.lit(V.PATH_SCHEME), _col(path))


def strip_scheme(path):
    return F.replace(_col(path), F.lit(V.PATH_SCHEME), F.lit(""))


def extension(path):
    """Lower-case extension with its dot; names made of leading dots have none."""
    name = F.regexp_replace(F.lower(base_name(path)), r"^\.+", "")
    return F.when(F.instr(name, ".") == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.substring_index(name, ".", -1))
    )


def is_supported(path):
    return extension(path).isin(V.SUPPORTED_EXTENSIONS)


def trim_path(path, depth=5):
    """What is left of a path after its first `depth` parts."""
    parts = F.split(_col(path), "/")
    return F.array_join(
        F.slice(parts, depth + 1, F.greatest(F.size(parts) - depth, F.lit(0))), "/"
    )


def volume_folder(document_type, volume):
    """Core documents live in one folder of the volume, all others in the temporary one."""
    return F.when(
        _col(document_type) == "core", F.concat(_col(volume), F.lit(f"/{V.CORE_FOLDER}"))
    ).otherwise(F.concat(_col(volume), F.lit(f"/{V.TEMPORARY_FOLDER}")))


def has_valid_environment(name):
    return F.element_at(F.split(_col(name), "_"), -1).isin(V.ENVIRONMENTS)


def has_valid_domain(name):
    return F.element_at(F.split(_col(name), "_"), 1).isin(V.DOMAINS)


def is_model_name(name):
    return F.element_at(F.split(_col(name), "_"), -1) == V.MODEL_SUFFIX


def matches_environment(name, environment):
    return F.element_at(F.split(_col(name), "_"), -1) == _col(environment)
