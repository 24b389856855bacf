"""Run the continuous job with settings from the environment.

Submit this file with the package on the Python path and the Kafka source for the Spark version
in ``--packages``.
"""

from fieldpulse.session import build_session
from fieldpulse.streaming.job import StreamConfig, start_stream


def main() -> None:
    start_stream(build_session("fieldpulse"), StreamConfig.from_env()).awaitTermination()


if __name__ == "__main__":
    main()
