"""The streaming form of metering and billing."""
