"""fleetpulse: device-heartbeat analytics as plain PySpark DataFrame jobs."""
