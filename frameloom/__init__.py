"""frameloom: a PySpark-native engine for episodic sensor data and training corpora."""
