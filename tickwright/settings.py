"""Run-time settings, taken from environment variables with fixed defaults."""

import os
from dataclasses import dataclass


# The names of the environment variables, and the defaults.
@dataclass(frozen=True)
class Settings:
    kafka_servers: str = "localhost:9092"
    kafka_topic: str = "market_ticks"
    window_seconds: int = 10
    slide_seconds: int = 10
    symbol: str = "IBM"
    output_dir: str = "output"
    checkpoint_dir: str = "output/checkpoints"
    max_per_trigger: int = 0  # messages (or files) of a micro-batch at most; 0: all there are

    @staticmethod
    def from_env(env=None) -> "Settings":
        env = os.environ if env is None else env
        base = Settings()
        return Settings(
            kafka_servers=env.get("KAFKA_BOOTSTRAP_SERVERS", base.kafka_servers),
            kafka_topic=env.get("KAFKA_TOPIC", base.kafka_topic),
            window_seconds=int(env.get("STREAM_WINDOW_SECONDS", base.window_seconds)),
            slide_seconds=int(env.get("STREAM_SLIDE_SECONDS", base.slide_seconds)),
            symbol=env.get("ALPHAVANTAGE_SYMBOL", base.symbol),
            output_dir=env.get("OUTPUT_DIR", base.output_dir),
            checkpoint_dir=env.get("CHECKPOINT_DIR", base.checkpoint_dir),
            max_per_trigger=int(env.get("STREAM_MAX_PER_TRIGGER", base.max_per_trigger)),
        )

    @property
    def window(self) -> str:
        return f"{self.window_seconds} seconds"

    @property
    def slide(self) -> str:
        return f"{self.slide_seconds} seconds"

    def table(self, name: str) -> str:
        return f"{self.output_dir}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.checkpoint_dir}/{name}"


# Watermark, thresholds and sizes of views.
WATERMARK = "2 minutes"
MIN_SILVER_ROWS = 30      # below this the training set is topped up with history
MIN_HISTORY_ROWS = 120    # a cached history table is reused from this size on
MIN_TRAINING_ROWS = 10    # fewer labelled rows than this is an error
TRAIN_SHARE = 0.8
LATEST_BATCHES = 30
LATEST_WINDOWS = 40
LATEST_PREDICTIONS = 500
LATEST_RUNS = 6
HISTOGRAM_BINS = 30
