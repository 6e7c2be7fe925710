"""The starting ontology."""

# Class and relation names in order, one repeat in each list kept.
CLASSES = """
Concept Technology Framework Library Language Architecture Pattern Component Module Service Interface API Middleware
Protocol Tool BuildTool PackageManager IDE Debugger Profiler TestingFramework VersionControl Database DataStructure
Collection Cache FileSystem Storage Repository WebFramework HTTPMethod Request Response Authentication Authorization
Security Encryption Frontend UI Component Hook State Event DOM CSS HTML JavaScript Backend Server Microservice Container
Cloud Deployment Environment Configuration Process Methodology Testing Documentation Performance Optimization Monitoring
Logging Object Class Method Function Variable Parameter ReturnType Exception Error
""".split()
RELATIONS = """
hasConcept isTypeOf uses implements extends inherits contains belongsTo partOf hasFramework hasLibrary hasFeature
hasComponent hasModule hasHook hasMethod hasProperty developedBy usedFor basedOn buildsOn dependsOn requires supports
manages configures calls invokes triggers handles processes exposes consumes produces returns throws communicatesWith
connectsTo authenticates authorizes serves requests responds routes proxies orchestrates monitors controls initializes
deploys scales balances caches stores stores retrieves queries updates deletes serializes deserializes validates
transforms tests debugs profiles documents versions compiles builds packages releases
""".split()
