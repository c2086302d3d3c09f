"""Sessions with settings of their own."""


def session_with(spark, **settings):
    """A session on the same cluster with ``spark``'s settings and a few others.

    Names have ``__`` for dots. The settings of ``spark`` itself, which other threads may
    be using, stay as they are. Temporary views and functions are not shared.
    """
    other = spark.newSession()
    wanted = dict(spark.conf.getAll) | {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in wanted.items():
        if other.conf.isModifiable(name) and other.conf.get(name, None) != value:
            other.conf.set(name, value)
    return other
