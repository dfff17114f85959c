"""The steps of metering and billing, each from DataFrame to DataFrame."""
