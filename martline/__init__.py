"""martline: a Spark-native sales-mart engine.

Every public function takes and returns ``DataFrame`` objects; no function
here creates a session except :func:`martline.session.build_session`, which
tests and the bench use.
"""

__version__ = "0.1.0"
